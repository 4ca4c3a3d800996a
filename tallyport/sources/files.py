"""Listing folders on whatever file system Spark reads from. Only names are listed, never rows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def has_rows_written(spark: SparkSession, path: str) -> bool:
    """A file, or a folder whose write was finished."""
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return False
    return fs.getFileStatus(hadoop_path).isFile() or exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def child_names(spark: SparkSession, path: str) -> list[str]:
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        raise FileNotFoundError(f"{path} does not exist")
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def matching_children(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names under ``path`` that match a glob pattern."""
    hadoop_path, fs = _path(spark, f"{path.rstrip('/')}/{pattern}")
    return sorted(status.getPath().getName() for status in fs.globStatus(hadoop_path) or [])


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a text file, or of the first part file of a written folder."""
    hadoop_path, fs = _path(spark, path)
    if not fs.getFileStatus(hadoop_path).isFile():
        parts = [n for n in child_names(spark, path) if not n.startswith(("_", "."))]
        if not parts:
            return ""
        return first_line(spark, f"{path.rstrip('/')}/{parts[0]}")
    jvm = spark._jvm
    stream = fs.open(hadoop_path)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    """Removes a file or a folder with all it holds; False if there was nothing."""
    hadoop_path, fs = _path(spark, path)
    return bool(fs.delete(hadoop_path, True))


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Moves ``source`` to ``target``, which must not exist yet (checked by ``claim`` beforehand)."""
    hadoop_source, fs = _path(spark, source)
    return bool(fs.rename(hadoop_source, spark._jvm.org.apache.hadoop.fs.Path(target)))


def claim(spark: SparkSession, path: str) -> bool:
    """Creates the empty file ``path`` only if nothing is there: True for the one caller that made it.

    The file system's create without overwrite fails for all but the first of several callers.
    """
    hadoop_path, fs = _path(spark, path)
    try:
        fs.create(hadoop_path, False).close()
    except Exception as error:  # py4j wraps the file system's "already exists"
        if fs.exists(hadoop_path):
            return False
        raise error
    return True


def leaf_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, size, modification time) of every file below ``path``, hidden ones (``_``, ``.``) left out.

    Only the file system's listing is read, never a row; its length is the number of files.
    """
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    base = fs.makeQualified(hadoop_path).toString().rstrip("/")
    found, listing = [], fs.listFiles(hadoop_path, True)
    while listing.hasNext():
        status = listing.next()
        name = status.getPath().toString()
        relative = name.removeprefix(base)
        if not any(part.startswith(("_", ".")) for part in relative.split("/") if part):
            found.append((name, int(status.getLen()), int(status.getModificationTime())))
    return sorted(found)
