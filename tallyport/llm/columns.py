"""Column expressions shared by the operators that stay on built-in functions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns: words without white space, and separators of folded words.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
FOLDED_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOLDED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: a side is broadcast only if it was written and is no larger than this
BROADCAST_BYTES = 8 << 20


def folded(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged. Pure ASCII, where ``lower`` does just that, takes the faster way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def folded_words(text: Column) -> Column:
    """Folded words in order; none for null."""
    return F.coalesce(F.array_remove(F.split(folded(text), FOLDED_SEPARATOR), ""), F.array().cast("array<string>"))


def written_bytes(df: DataFrame) -> int:
    """Size of a table read back from the shared folder, by its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame) -> DataFrame:
    """Hint a broadcast for a written table within the bound; leave a larger one to a shuffled join."""
    return F.broadcast(df) if written_bytes(df) <= BROADCAST_BYTES else df
