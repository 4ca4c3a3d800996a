import os

import pytest

from pyspark.sql import functions as F

from tallyport import session


class Unconfigured:
    """A session whose cluster names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "local[2]"

        @staticmethod
        def getCheckpointDir():
            return None


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        assert session.shared_dir(spark) == configured.rstrip("/")
    else:
        assert os.path.isdir(session.shared_dir(spark))


def test_shared_dir_without_configuration():
    first, second = session.shared_dir(Unconfigured), session.shared_dir(Unconfigured)
    assert os.path.isdir(first) and os.path.isdir(second) and first != second


def test_cut_lineage(spark, rows):
    df = spark.range(20, numPartitions=4).select("id", F.lit("2020-01-02").cast("timestamp_ntz").alias("t"))
    cut = session.cut_lineage(df)
    assert rows(cut) == rows(df) and cut.dtypes == df.dtypes
    assert "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_a_cluster_must_name_its_shared_folder():
    class Cluster(Unconfigured):
        class sparkContext(Unconfigured.sparkContext):
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)


def test_clear_scratch(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    session.cut_lineage(spark.range(3))
    folder = session._scratch[0].removeprefix("file://")
    assert os.path.isdir(folder) and session.clear_scratch(spark) == 1 and not os.path.exists(folder)
