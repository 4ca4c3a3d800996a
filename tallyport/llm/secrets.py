"""Finds secrets: fixed key patterns, and long strings whose characters look random.

A candidate is an unbroken run of key characters. For each character class a window slides over it while the
counts of its characters are kept up: one character enters, one leaves, and the sum of c*log2(c), from which
Shannon entropy follows, changes by those two only. A candidate is reported for the first class one of whose
windows is random enough, unless the allow-list knows all its parts between separators as harmless.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds. A match that is too short is dropped after it has used up its characters.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs of one class are whole, so for these two the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
# from the smallest window on
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}+"
SEPARATOR = r"[+/_=-]"


class CharacterClass(NamedTuple):
    """Characters, window length and least entropy (bits a character) of one class."""

    name: str
    pattern: str
    window: int
    least_bits: float


CLASSES = (
    CharacterClass("hex", r"^[0-9A-Fa-f]+$", 16, 2.9),
    CharacterClass("base32", r"^[A-Z2-7]+=*$", 20, 3.4),
    CharacterClass("base64", r"^[A-Za-z0-9+/_=-]+$", 20, 3.6),
)
_UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
_PLACEHOLDER = (r"(?i:example[a-z0-9]*|placeholder|changeme|lorem|x{4,}"
                r"|(?:0123456789|abcdefghijklmnopqrstuvwxyz|abcdefgh|abcdef)++)")
_LETTERS = r"[a-z]+|[A-Z]+|[A-Z][a-z]+"
_NUMBERED = r"[0-9]+|[a-z]{1,11}[0-9]{1,4}|[0-9]{1,4}[a-z]{1,11}"
#: Harmless candidates. The last two look at each part between separators, and one part that is none of theirs will do to keep
#: a candidate: words of one case (or with a capital first) and placeholders without other digits; and, in small letters behind
#: a separated word, also numbers and short words with a number. UUIDs may stand in both.
ALLOWED = (
    rf"^{_UUID}$",
    r"^(.)\1+$",
    r"^[0-9_=-]+$",
    rf"^(?:{SEPARATOR}|(?:{_UUID}|{_LETTERS}|{_PLACEHOLDER})(?![A-Za-z0-9]))*+$",
    rf"^(?=.*[-_/][a-z]+(?:[-_/]|$))(?:[-_/]|(?:{_UUID}|[a-z]+|{_NUMBERED}|{_PLACEHOLDER})(?![A-Za-z0-9]))*+$",
)
#: a hexadecimal part with a digit and a letter, or with letters of both cases
_HEX_PART = r"^(?=.*[0-9].*[A-Fa-f]|.*[A-Fa-f].*[0-9]|.*[A-F].*[a-f]|.*[a-f].*[A-F])[0-9A-Fa-f]+$"


def _matches(text: Column, pattern: str, kind: int, least: int, group: int = 0) -> Column:
    """All matches in order as structs start, kind, end, value; those whose group is shorter than ``least`` dropped.

    The pieces between matches and the matches themselves add up to positions in code points.
    """
    def build(bound):
        found, between = bound["found"], bound["between"]
        # running ends: piece, match, piece, match, ...
        walked = F.aggregate(
            F.sequence(F.lit(0), F.size(found) - 1),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>").alias("out")),
            lambda state, i: F.struct(
                (state["at"] + F.length(F.get(between, i)) + F.length(F.get(found, i))).alias("at"),
                F.when(
                    (F.length(F.regexp_extract(F.get(found, i), pattern, group)) if group else F.length(F.get(found, i))) >= least,
                    F.concat(state["out"], F.array(F.struct(
                        (state["at"] + F.length(F.get(between, i))).alias("start"), F.lit(kind).alias("kind"),
                        (state["at"] + F.length(F.get(between, i)) + F.length(F.get(found, i))).alias("end"),
                        F.get(found, i).alias("value")))),
                ).otherwise(state["out"]).alias("out"),
            ),
        )["out"]
        nothing = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
        return F.when(F.size(found) > 0, walked).otherwise(nothing)

    bound = F.array(F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between")))
    return F.get(F.transform(bound, build), 0)


def _entropy_reached(value: Column, window: int, least_bits: float) -> Column:
    """Whether some ``window`` consecutive characters have at least ``least_bits`` of Shannon entropy.

    H = log2(w) - sum(c * log2(c)) / w, so the largest entropy is the smallest sum. ``logs[c]`` is c * log2(c), up to
    window + 1, as a character enters before another leaves.
    """
    logs = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(window + 2)])
    most = window * (math.log2(window) - least_bits) + 1e-9

    def scan(chars):
        def step(state, i):
            entering, leaving = F.get(chars, i), F.when(i >= window, F.get(chars, i - window))
            c_in = F.coalesce(F.element_at(state["counts"], entering), F.lit(0))

            def entered(bound):
                counts = F.map_concat(
                    F.map_filter(state["counts"], lambda k, _: k != entering), F.create_map(entering, c_in + 1))
                c_out = F.coalesce(F.element_at(counts, leaving), F.lit(0))
                total = state["sum"] + F.get(logs, c_in + 1) - F.get(logs, c_in)
                return F.struct(
                    F.when(leaving.isNull(), counts).otherwise(
                        F.map_concat(F.map_filter(counts, lambda k, _: k != leaving), F.create_map(leaving, c_out - 1))).alias("counts"),
                    F.when(leaving.isNull(), total).otherwise(total + F.get(logs, F.greatest(c_out - 1, F.lit(0))) - F.get(logs, c_out)).alias("sum"),
                )

            moved = F.get(F.transform(F.array(F.lit(0)), entered), 0)
            return F.get(F.transform(F.array(moved), lambda m: F.struct(
                m["counts"].alias("counts"), m["sum"].alias("sum"),
                F.when(i >= window - 1, F.least(state["best"], m["sum"])).otherwise(state["best"]).alias("best"))), 0)

        start = F.struct(F.create_map().cast("map<string,int>").alias("counts"), F.lit(0.0).alias("sum"), F.lit(1e9).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, step)["best"] <= most

    long_enough = F.length(value) >= window
    return long_enough & F.get(F.transform(F.array(F.split(value, "")), scan), 0)


def _random_looking(value: Column) -> Column:
    """The class rules, tried from the narrowest alphabet to the widest, and the allow-list.

    Parts between separators that are hexadecimal are also judged by themselves, as their window is smaller.
    """
    narrow = CLASSES[0]
    decided = F.lit(False)
    for kind in reversed(CLASSES):
        decided = F.when(value.rlike(kind.pattern), _entropy_reached(value, kind.window, kind.least_bits)).otherwise(decided)
    decided = decided | F.exists(F.split(value, SEPARATOR), lambda part: F.when(
        part.rlike(_HEX_PART), _entropy_reached(part, narrow.window, narrow.least_bits)).otherwise(False))
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | value.rlike(pattern)
    return F.when(allowed, F.lit(False)).otherwise(decided)


KINDS = ("assign", "access", "hex", "entropy")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, kind, end, value) in order of start, then kind.

    ``kind`` is a place in ``KINDS``; positions count code points, ends are exclusive. ``base`` has the three
    fixed kinds, ``spans`` also random-looking candidates that overlap no base span. Null and empty texts
    have no span. Columns with these names are replaced, others pass through. Every row is treated by itself, so nothing is shuffled and repeated rows agree.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.array_sort(F.concat(_matches(text, ASSIGN, 0, 12, 1), _matches(text, ACCESS, 1, 18), _matches(text, HEX, 2, 16)))
    with_base = docs.withColumn("base", base)
    candidates = F.filter(
        _matches(text, CANDIDATE, 3, CLASSES[0].window),
        lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])) & _random_looking(c["value"]),
    )
    return with_base.withColumn("spans", F.array_sort(F.concat("base", candidates)))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
