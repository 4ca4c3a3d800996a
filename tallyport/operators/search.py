"""Which rows mention a name in any of their cells."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.functions.text import normalize_name
from tallyport.operators.joins import BROADCAST_BYTES
from tallyport.session import cut_lineage

#: length of the text pieces by which rows and names find each other
PIECE = 6


def any_cell_contains(columns: Sequence[str], names: Sequence[str]) -> Column:
    """Whether a cell contains one of a few given names; missing cells never do.

    For a list of names held in a table use ``contains_join``.
    """
    cells = [F.coalesce(normalize_name(c), F.lit("")) for c in columns]
    needles = [normalize_name(F.lit(n)) for n in names]
    found = F.lit(False)
    for needle in needles:
        for cell in cells:
            found = found | F.contains(cell, needle)
    return found


def keep_listed_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Those of ``wanted`` that the table has, each row once."""
    return df.select(*[c for c in wanted if c in df.columns]).distinct()


def distinct_names(rows: DataFrame, column: str) -> DataFrame:
    """Distinct names of a column as ``institution_name``, without the missing one."""
    return rows.select(F.col(column).alias("institution_name")).where(
        F.col("institution_name").isNotNull()
    ).distinct()


def _pieces(text: Column, length: int) -> Column:
    """All overlapping pieces of a length, in one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{length}}}))"), F.lit(1))


def _pieces_of_length(length: int) -> Callable[[Column], Column]:
    return lambda cell: _pieces(cell, length)


def _anchors(needles: DataFrame) -> DataFrame:
    """For each name, the piece that the fewest other names have in common.

    The pieces of a name are counted over all names, and the rarest is taken, so a common beginning
    such as "university of" does not make many names meet in one key.
    """
    length = F.least(F.char_length("institution"), F.lit(PIECE))
    by_length = F.when(length >= PIECE, F.array_distinct(_pieces(F.col("institution"), PIECE)))
    pieces = needles.select("institution", F.explode(
        F.coalesce(by_length, F.array("institution"))
    ).alias("piece"))
    spread = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("names"))
    return (
        pieces.join(spread, "piece")
        .groupBy("institution")
        .agg(F.min(F.struct("names", "piece")).getField("piece").alias("piece"))
    )


@dataclass(frozen=True)
class Needles:
    """Names ready to be searched for; made by ``prepare_names``."""

    anchors: DataFrame
    lengths: tuple[int, ...]
    small: bool

    def joined_to(self, df: DataFrame, on: str) -> DataFrame:
        return df.join(F.broadcast(self.anchors) if self.small else self.anchors, on)


def prepare_names(names: DataFrame, limit: int = BROADCAST_BYTES) -> Needles:
    """Normalized distinct names with their anchors, written down once and measured.

    ``names`` has a column ``institution_name`` and often comes from a large log, so it is not
    computed again for every search. Blank names are left out. The anchors are broadcast later only
    if their measured size is within ``limit``.
    """
    needles = names.select(normalize_name("institution_name").alias("institution")).where(
        F.col("institution") != ""
    ).distinct()
    anchors = cut_lineage(_anchors(needles))
    # an anchor has at most PIECE characters, so there are at most PIECE lengths
    measured = anchors.agg(
        F.collect_set(F.char_length("piece")).alias("lengths"),
        F.coalesce(
            F.sum(F.octet_length("institution") + F.octet_length("piece") + 32), F.lit(0)
        ).alias("bytes"),
    ).first()
    return Needles(anchors, tuple(sorted(measured["lengths"])), measured["bytes"] <= limit)


def contains_join(
    rows: DataFrame, names: DataFrame | Needles, columns: Sequence[str] | None = None
) -> DataFrame:
    """``rows`` with ``institution``, the normalized name found in a cell, once per name found.

    A substring join without comparing every row with every name. Each name has one anchor piece
    that any text containing the name contains as well. A row offers its pieces, the anchors are
    joined by equality, and the few candidates are checked in full. A row meets each name at most
    once, as its pieces are distinct and a name has a single anchor. ``columns`` limits which cells
    are searched.
    """
    needles = names if isinstance(names, Needles) else prepare_names(names)
    if not needles.lengths:
        return rows.limit(0).withColumn("institution", F.lit(None).cast("string"))
    cells = F.array_compact(F.array(*[normalize_name(c) for c in columns or rows.columns]))
    offered = F.array_distinct(F.flatten(F.concat(*[
        F.transform("__cells", _pieces_of_length(n)) for n in needles.lengths
    ])))
    # pieces travel with the row's hash alone, however long its cells are; the row joins again once per name.
    # Rows that are equal share a hash and their candidates, and every candidate is checked in full.
    searched = rows.withColumn("__row", F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])).withColumn("__cells", cells)
    offers = searched.select("__row", F.explode(offered).alias("piece"))
    found = needles.joined_to(offers, "piece").select("__row", "institution").distinct()
    candidates = searched.join(found, "__row")
    confirmed = F.exists("__cells", lambda cell: F.contains(cell, F.col("institution")))
    return candidates.where(confirmed).select(*rows.columns, "institution")
