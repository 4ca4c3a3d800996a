"""Finds licences in texts: notice phrases, identifier tags, and the expressions that follow the tags.

One Aho-Corasick automaton runs over a text's folded words and finds all phrases at once, another over the
lower-cased text finds the tags. What follows a tag is read by a shunting-yard parser with the usual
precedence (with, then and, then or) and evaluated: which licences it names, and whether a permissive choice
remains (one side of an or is enough, an and needs both).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from tallyport.llm.words import folded_words, utf8

# Phrases that every scan looks for, as folded words, with their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# further notices and names with their labels and how sure they are
PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.8),
    "the mit license": ("mit", 0.7),
    "mit license": ("mit", 0.6),
    "licensed under the apache license": ("apache-2", 0.8),
    "apache license 2 0": ("apache-2", 0.7),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "bsd 2 clause": ("bsd", 0.7),
    "bsd 3 clause": ("bsd", 0.7),
    "bsd license": ("bsd", 0.6),
    "gnu general public license": ("gpl", 0.8),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "isc license": ("isc", 0.7),
    "boost software license": ("bsl", 0.7),
    "free and unencumbered software released into the public domain": ("unlicense", 0.8),
    "creative commons attribution": ("cc-by", 0.6),
    "cc by sa": ("cc-by-sa", 0.7),
    "cc by nd": ("cc-by-nd", 0.7),
    "cc by 4 0": ("cc-by", 0.7),
    "cc0 1 0": ("cc0", 0.7),
    "all rights reserved": ("all-rights-reserved", 0.4),
}
TAGS = ("spdx-license-identifier:", "license-identifier:", "license-expression:")
# Identifier prefixes (lower case), their labels, and whether they are permissive. The longest applies.
IDENTIFIERS = {
    "0bsd": ("0bsd", True), "agpl-": ("agpl", False), "apache-1": ("apache-1", True), "apache-2": ("apache-2", True),
    "artistic-": ("artistic", True), "bsd-": ("bsd", True), "bsl-": ("bsl", True), "cc-by-": ("cc-by", True),
    "cc-by-nc-": ("cc-by-nc", False), "cc-by-nd-": ("cc-by-nd", False), "cc-by-sa-": ("cc-by-sa", False),
    "cc0-": ("cc0", True), "epl-": ("epl", False), "eupl-": ("eupl", False), "gpl-": ("gpl", False),
    "isc": ("isc", True), "lgpl-": ("lgpl", False), "mit": ("mit", True), "mpl-": ("mpl", False),
    "ncsa": ("ncsa", True), "postgresql": ("postgresql", True), "python-": ("python", True),
    "unlicense": ("unlicense", True), "wtfpl": ("wtfpl", True), "zlib": ("zlib", True),
    "licenseref-": ("other", False), "proprietary": ("proprietary", False),
}
# SPDX names without a digit or hyphen in lower case, which look like words of prose
LOWER_NAMES = frozenset(
    "blessing curl diffmark dtoa dvipdfm etalab gnuplot hdparm libtiff lsof magaz metamail mpich mplus "
    "pnmstitch psfrag psutils snprintf softsurfer swrule threeparttable ulem xinetd xkeyboard xlock xpp xzoom".split())
BASE_SURE, TAG_SURE = 0.9, 0.95
# a name ends in a letter, digit or plus, so that a full stop or the end of a comment is not taken into it
_TOKEN = re.compile(
    r"[ \t]*(?:(\()|(\))|((?:DocumentRef-[A-Za-z0-9.-]+:(?=LicenseRef-))?[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?))")
_BEFORE_OPERATOR = re.compile(r"[ \t]+(?:AND|OR|WITH)(?![A-Za-z0-9.+-])")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


class Expression(NamedTuple):
    """``text`` as read, in postfix order ``postfix``; distinct ``labels``; is some choice ``permissive``."""

    text: str
    postfix: list[str]
    labels: list[str]
    permissive: bool


def _identified(name: str) -> tuple[str, bool]:
    """Label of an identifier and whether it is permissive. One outside the table is its own label and not permissive."""
    low = name.lower().rpartition(":")[2]
    known = [p for p in IDENTIFIERS if low == p or low.rstrip("+") == p or p.endswith("-") and low.startswith(p)
             or p[-1].isdigit() and low.startswith(p)]
    return IDENTIFIERS[max(known, key=len)] if known else (low.rstrip("+"), False)


def _is_prose(name: str) -> bool:
    """Whether a name is in nothing but small letters and no licence's, like the words after ``MIT and``."""
    return name.isalpha() and name.islower() and name not in IDENTIFIERS and name not in LOWER_NAMES


def parse_expression(text: str, start: int = 0) -> Expression | None:
    """The longest well-formed expression that begins at ``start``; None if there is none.

    Every name in the place of an operand is an identifier, also one outside the table; only a word in small letters
    that names no licence is prose, unless an operator in capitals stands beside it. Reading stops at the end of the line
    and at whatever cannot go on: prose, two operands in a row, an unmatched parenthesis. An operator without a right
    side is given back.
    """
    output: list[str] = []
    stack: list[str] = []
    best: tuple[int, list[str]] | None = None
    wants_operand, after_with, capitals, at = True, False, False, start
    while match := _TOKEN.match(text, at):
        opening, closing, word = match.groups()
        operator = word and word.lower() in _PRECEDENCE
        if wants_operand:
            if opening and not after_with:
                stack.append("(")
            elif word and not operator and (
                    after_with or capitals or not _is_prose(word) or _BEFORE_OPERATOR.match(text, match.end())):
                output.append(word)
                wants_operand, after_with = False, False
            else:
                break
        elif closing and "(" in stack:
            while (top := stack.pop()) != "(":
                output.append(top)
        elif operator:
            name = word.lower()
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[name]:
                output.append(stack.pop())
            stack.append(name)
            wants_operand, after_with, capitals = True, name == "with", word.isupper()
        else:
            break
        at = match.end()
        if not wants_operand and "(" not in stack:
            best = at, [*output, *reversed(stack)]
    if best is None:
        return None
    end, postfix = best
    labels, permissive = evaluate(postfix)
    return Expression(text[start:end].strip(), postfix, labels, permissive)


def evaluate(postfix: list[str]) -> tuple[list[str], bool]:
    """Labels named by a postfix expression, and whether a permissive choice remains. Exceptions change neither."""
    values: list[tuple[frozenset[str], bool]] = []
    for token in postfix:
        if token not in _PRECEDENCE:
            label, permissive = _identified(token)
            values.append((frozenset([label]), permissive))
            continue
        right, left = values.pop(), values.pop()
        if token == "with":
            values.append(left)
        else:
            choice = left[1] or right[1] if token == "or" else left[1] and right[1]
            values.append((left[0] | right[0], choice))
    return sorted(values[0][0]), values[0][1]


def _automaton(patterns: dict[str, object]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        automaton.add_word(pattern, value)
    automaton.make_automaton()
    return automaton


def _phrase_automaton() -> ahocorasick.Automaton:
    patterns: dict[str, list] = {}
    for phrase, label in BASE_PHRASES.items():
        patterns.setdefault(f" {phrase} ", [phrase.count(" ") + 1]).append((label, BASE_SURE, True))
    for phrase, (label, sure) in PHRASES.items():
        patterns.setdefault(f" {phrase} ", [phrase.count(" ") + 1]).append((label, sure, False))
    return _automaton(patterns)


def scan_text(text: bytes, phrases, tags) -> tuple[int, list[dict], list[dict], float]:
    """Number of words, places of phrases, expressions, and the score of one text."""
    words = folded_words(text)
    # one character a byte, so that positions need no decoding; phrases are ASCII
    line = " " + b" ".join(words).decode("latin-1") + " "
    places, sure, counted, number = [], {}, 0, -1
    for end, (length, *hits) in phrases.iter(line):
        number += line.count(" ", counted, end + 1)  # blanks so far, less one: the word that would come next
        counted = end + 1
        for label, weight, base in hits:
            places.append({"start": number - length + 1 - 1, "label": label, "base": base})
            sure[label] = max(sure.get(label, 0.0), weight)
    expressions = []
    low = text.lower().decode("latin-1")
    plain, done = None, 0
    for end, _ in tags.iter(low):
        if end < done:
            continue
        plain = text.decode("latin-1") if plain is None else plain
        found = parse_expression(plain, end + 1)
        if found:
            done = end + 1
            expressions.append({"text": found.text, "postfix": found.postfix, "labels": found.labels, "permissive": found.permissive})
            for label in found.labels:
                sure[label] = max(sure.get(label, 0.0), TAG_SURE)
    doubt = 1.0
    for label in sorted(sure):
        doubt *= 1 - sure[label]
    return len(words), places, expressions, 1 - doubt


_PLACES = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))
_EXPRESSIONS = pa.list_(pa.struct([
    ("text", pa.string()), ("postfix", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("permissive", pa.bool_())]))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words``, ``places``, ``expressions`` and ``score``.

    ``places``: ``start`` (in words, from 0), ``label`` and ``base`` of every occurrence of every phrase, overlapping
    ones too. ``expressions``: what follows each tag. ``score``: 0 without any finding, otherwise one minus the
    product of the doubts about each label. Null counts as empty. Columns with these
    names are replaced, others pass through. Each row is treated by itself: nothing is shuffled.
    """
    docs = docs.drop("n_words", "places", "expressions", "score")
    names = docs.columns
    places = ArrayType(StructType([StructField("start", LongType()), StructField("label", StringType()),
                                   StructField("base", BooleanType())]))
    expressions = ArrayType(StructType([StructField("text", StringType()), StructField("postfix", ArrayType(StringType())),
                                        StructField("labels", ArrayType(StringType())), StructField("permissive", BooleanType())]))
    schema = StructType(docs.schema.fields + [StructField("n_words", LongType()), StructField("places", places),
                                              StructField("expressions", expressions), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, tags = _phrase_automaton(), _automaton({t: t for t in TAGS})
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index("text")))
            rows = [scan_text(t or b"", phrases, tags) for t in texts]
            n_words, places, expressions, score = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_words, pa.int64()), pa.array(places, _PLACES),
                 pa.array(expressions, _EXPRESSIONS), pa.array(score, pa.float64())],
                [*names, "n_words", "places", "expressions", "score"])

    return docs.mapInArrow(run, schema)
