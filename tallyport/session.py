"""Session settings and the shared folders jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins, merges small shuffle partitions and splits skewed ones at run time.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # call sites for error messages cost several round trips to the JVM per column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tallyport", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = _SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a single-machine session may go without it and gets a temporary folder. On a cluster such a folder
    would be another one on each executor, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    _scratch.append(folder)
    return f"{folder}/{name}"


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process made; call it when all results have been written.

    Returns their number. Frames that still read a scratch table cannot be used afterwards.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    cleared = 0
    while _scratch:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        cleared += path.getFileSystem(hadoop).delete(path, True)
    return cleared


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from the written rows.

    Later steps read what was written, so a lost executor cannot change or repeat the work before.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
