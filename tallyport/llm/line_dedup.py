"""Removes lines that repeat elsewhere, by overlapping windows of three lines.

Every three consecutive lines are hashed; a window that also starts earlier (smaller ``doc_id``, then
earlier line) is a later occurrence, and the lines of all later occurrences go. Windows overlap, so a long
repeated passage is removed as one piece by merging what its windows cover.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _window_keys(lines: Column, width: int) -> Column:
    """One struct per window: line number and two independent 64-bit hashes. Blank windows have none."""
    def key(i):
        parts = [F.get(lines, i + j) for j in range(width)]
        return F.struct(
            i.alias("line"), F.xxhash64(*parts).alias("key1"), F.xxhash64(F.lit(7), *parts).alias("key2"),
            (F.trim(F.concat(*parts)) != "").alias("filled"),
        )

    starts = F.when(F.size(lines) >= width, F.sequence(F.lit(0), F.size(lines) - width))
    return F.transform(starts, key)


def _picked(lines: Column, places: Column) -> Column:
    """The lines at ``places``; the lambda's name binds the lines, so that they are split once."""
    return F.get(F.transform(F.array(lines), lambda bound: F.transform(places, lambda i: F.get(bound, i))), 0)


def line_windows(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id``, ``text_hash``, ``line`` and two hashes of every window with something in it."""
    lined = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines"))
    return (
        lined.select("doc_id", "text_hash", F.explode(_window_keys(F.col("lines"), width)).alias("w"))
        .filter("w.filled").select("doc_id", "text_hash", "w.line", "w.key1", "w.key2")
    )


def dedupe_lines(docs: DataFrame, width: int = 3) -> DataFrame:
    """``docs`` with ``text`` cut to the lines that stay, plus ``n_lines`` and ``n_removed``.

    Lines end at U+000A. Null text has no lines and stays null; empty text is one blank line. Documents with
    fewer lines than ``width`` have no window and stay whole. Rows with the same ``doc_id`` and text are one
    document and lose the same lines; a null ``doc_id`` counts as smallest. A text that loses all lines
    becomes empty. Columns named like the results or like the working columns (``_key``, ``_doc``, ``_hash``,
    ``_starts``, ``_kept``) are replaced or dropped, others pass through.
    """
    docs = docs.drop("n_lines", "n_removed", "_key", "_doc", "_hash", "_starts", "_kept")
    windows = line_windows(docs, width)
    start = F.struct("doc_id", "text_hash", "line")
    # one row per repeated window; sums up before the shuffle, so a window found everywhere is no hot key
    repeated = (
        windows.groupBy("key1", "key2").agg(F.min(start).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").drop("n")
    )
    first = F.col("first")
    later = (
        windows.join(repeated, ["key1", "key2"])
        .filter(
            F.when(F.col("doc_id").eqNullSafe(first["doc_id"]) & (F.col("text_hash") == first["text_hash"]),
                   F.col("line") > first["line"]).otherwise(F.lit(True))
        )
        .groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("_starts"))
    )
    keyed = docs.withColumn("_key", F.xxhash64("text"))
    marks = later.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "_starts")
    joined = keyed.join(marks, keyed["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_hash")), "left")
    lines = F.split("text", "\n")
    covered = F.flatten(F.transform("_starts", lambda s: F.sequence(s, s + (width - 1))))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    cut = joined.withColumn("_kept", F.when(F.col("_starts").isNotNull(), kept))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    return (
        cut.withColumn("n_lines", n_lines)
        .withColumn("n_removed", F.when(F.col("_kept").isNull(), 0).otherwise(F.col("n_lines") - F.size("_kept")).cast("long"))
        .withColumn("text", F.when(F.col("_kept").isNull(), F.col("text")).otherwise(
            F.array_join(_picked(F.split("text", "\n"), F.col("_kept")), "\n")))
        .select(*[F.col(f"`{c}`") for c in docs.columns], "n_lines", "n_removed")
    )
