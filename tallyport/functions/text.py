"""Column expressions for names, paths and row text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks that count as white space at the ends of a name.
_BLANKS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_name(c: Column | str) -> Column:
    """Lower-cased name without blanks at its ends, for matching only."""
    return F.lower(F.regexp_replace(_col(c).cast("string"), rf"^{_BLANKS}+|{_BLANKS}+$", ""))


def folder_slug(c: Column | str) -> Column:
    """Folder name of an institution: ends trimmed, commas out, blanks to underscores."""
    trimmed = F.regexp_replace(_col(c), rf"^{_BLANKS}+|{_BLANKS}+$", "")
    return F.replace(F.replace(trimmed, F.lit(","), F.lit("")), F.lit(" "), F.lit("_"))


def safe_path(c: Column | str, replacement: str = "_") -> Column:
    """Path with every hostile character replaced."""
    return F.regexp_replace(_col(c), r'[<>:"/\\|?*\x00 ]', replacement)


def safe_filename(c: Column | str) -> Column:
    """File name of letters, digits, ``_ - .`` and blanks.

    Where nothing else than blanks and underscores is left, a name made from the input's hash
    stands in, so a re-run gives the same name.
    """
    raw = _col(c)
    cleaned = F.regexp_replace(raw, r"[^\p{L}\p{N}_\-. ]", "_")
    nothing_left = F.regexp_replace(cleaned, "[_ ]", "") == ""
    return F.when(nothing_left, F.concat(F.lit("empty_name_"), F.md5(raw.cast("binary")))).otherwise(cleaned)


def strip_non_printable(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"[\x00-\x1f\x7f-\x9f]", "")


def row_text(columns: Iterable[str]) -> Column:
    """`` | ``-joined text of a row; a missing cell is empty."""
    return F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def header_text(columns: Iterable[str]) -> Column:
    return F.lit(" | ".join(columns))


def is_included(inner: Column | str, outer: Column | str) -> Column:
    """Whether every element of array ``inner`` is in array ``outer``; an empty one always is."""
    return F.size(F.array_except(_col(inner), _col(outer))) == 0
