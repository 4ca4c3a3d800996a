"""Removes word passages that also start earlier, with Aho-Corasick automata of the repeated phrases.

First, stretches of words that may hold a repeated window are found by a content-selected anchor that recurs. A
stretch whose words also occur earlier goes as a whole. Only the others bring their words: those of one anchor meet
in one shard, where phrases that recur by the hashes of their windows become the patterns of an automaton over words.
The shard's stretches stream through it, which locates every occurrence, word for word. An occurrence after the
first is removed; overlapping ones merge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm import recurrence
from tallyport.llm.columns import BROADCAST_BYTES, small, written_bytes
from tallyport.llm.words import WordHashes, covered, mixed, plain_words, signed, utf8, window_hashes
from tallyport.session import cut_lineage

K = 6
#: different stretches of one automaton
SHARD = 4000


class _Numbers(dict):
    """Words of a shard by number, so that the automaton compares words, not hashes."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self) + 1
        return value


def _with_words(marked: DataFrame, window: int) -> DataFrame:
    """``anchor``, ``doc_id``, ``key``, ``start``, ``size`` and ``words`` of the ``marks`` of each text.

    A mark that is ``split`` becomes one stretch for each of its windows, whose hash is its anchor.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                out: list[list] = [[] for _ in range(6)]
                for key, doc, text, marks in zip(
                        part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), part.column(3).to_pylist()):
                    words = plain_words(text)
                    for mark in marks:
                        start, size, anchor = mark["start"], mark["size"], mark["anchor"]
                        pieces = [(anchor, start, size)]
                        if mark["split"]:
                            hashes = signed(window_hashes(memo.of(words[start:start + size + window - 1]), window))
                            pieces = [(h, start + i, 1) for i, h in enumerate(hashes.tolist())]
                        for name, at, n in pieces:
                            row = (name, doc, key, at, n, b" ".join(words[at:at + n + window - 1]))
                            for column, value in zip(out, row):
                                column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(),) * 3 + (pa.int32(),) * 2 + (pa.binary(),))],
                    ["anchor", "doc_id", "key", "start", "size", "words"])

    return marked.select("key", "doc_id", "text", "marks").mapInArrow(
        cut, "anchor bigint, doc_id bigint, key bigint, start int, size int, words binary")


def _located(shard: pa.Table, window: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """``key``, ``start`` and ``size`` of runs of windows that start earlier, and which stretches hold a window that does not.

    ``shard`` has the stretches of some anchors in the order of their places.
    """
    key, start, size = (shard.column(c).to_numpy() for c in ("key", "start", "size"))
    numbers = _Numbers()
    words = b" ".join(shard.column("words").to_pylist()).split()
    codes = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    length = size + window - 1
    begin = np.cumsum(length) - length
    base = np.cumsum(size) - size  # number of each stretch's first window
    owner = np.repeat(np.arange(len(size)), size)
    number = np.arange(len(owner))
    at = begin[owner] + number - base[owner]
    _, first, which = np.unique(window_hashes(mixed(codes), window)[at], return_index=True, return_inverse=True)
    source = first[which]
    # windows in a row that all follow the same earlier ones make a phrase
    repeats = source != number
    follows = repeats[1:] & repeats[:-1] & (owner[1:] == owner[:-1]) & (source[1:] == source[:-1] + 1) & (owner[source[1:]] == owner[source[:-1]])
    heads = np.flatnonzero(repeats & ~np.concatenate([[False], follows]))
    ends = np.flatnonzero(repeats & ~np.concatenate([follows, [False]])) + 1
    text = codes.tolist()
    steps = np.zeros(len(owner) + 1, np.int64)
    if len(heads):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        sources = source[heads]
        for place, origin, n in zip(at[sources].tolist(), owner[sources].tolist(), (ends - heads).tolist()):
            automaton.add_word(tuple(text[place:place + n + window - 1]), (origin, n))
        automaton.make_automaton()
        for own in np.unique(owner[heads]).tolist():
            for end, (origin, n) in automaton.iter(tuple(text[begin[own]:begin[own] + length[own]])):
                if origin < own:
                    offset = base[own] + end - (n + window - 2)
                    steps[offset] += 1
                    steps[offset + n] -= 1
    later = np.cumsum(steps[:-1]) > 0
    joined = later[1:] & later[:-1] & (owner[1:] == owner[:-1])
    heads = np.flatnonzero(later & ~np.concatenate([[False], joined]))
    ends = np.flatnonzero(later & ~np.concatenate([joined, [False]])) + 1
    of = owner[heads]
    runs = pa.RecordBatch.from_arrays(
        [pa.array(key[of]), pa.array((start[of] + heads - base[of]).astype(np.int32)), pa.array((ends - heads).astype(np.int32))],
        ["key", "start", "size"])
    return runs, np.bincount(owner[~later], minlength=len(size)) > 0


def _later_in_shards(stretches: DataFrame, window: int) -> DataFrame:
    """``key``, ``start`` and ``size`` of runs of windows that start earlier in another of the ``stretches``.

    These come sorted by anchor and place. A task holds the stretches of one shard: whole anchors, up to ``SHARD`` stretches
    and one anchor more. Only a window's own group can be larger; the stretch it first starts in is carried on.
    """
    names = ["anchor", "doc_id", "key", "start"]

    def different(table: pa.Table) -> pa.Table:
        """Without rows of the input that repeat."""
        columns = [table.column(c).to_numpy() for c in names]
        return table.filter(pa.array(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD):
                table = pa.Table.from_batches([batch.slice(at, SHARD)])
                held = different(table if held is None else pa.concat_tables([held, table]))
                if held.num_rows < SHARD:
                    continue
                anchor = held.column("anchor").to_numpy()
                whole = int(np.searchsorted(anchor, anchor[-1]))
                if whole:
                    yield _located(held.slice(0, whole), window)[0]
                    held = held.slice(whole)
                if held.num_rows >= SHARD:
                    runs, fresh = _located(held, window)
                    yield runs
                    held = held.filter(pa.array(fresh))
        if held is not None and held.num_rows:
            yield _located(held, window)[0]

    dealt = stretches.repartition("anchor").sortWithinPartitions(*names)
    return dealt.mapInArrow(run, "key bigint, start int, size int")


def later_windows(rows: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """``key`` and ``runs`` (``start`` and ``size``) of windows whose words also start earlier.

    ``found`` as from ``recurrence.recurring_stretches``, written; ``rows`` have ``doc_id``, ``text`` and ``key``.
    """
    firsts = found.filter("anchor IS NOT NULL")
    # an anchor with more stretches than a shard holds is taken apart: each window goes by its own hash
    split = cut_lineage(firsts.groupBy("anchor").count().filter(F.col("count") > SHARD).select("anchor", F.lit(True).alias("split")))
    marks = firsts.join(small(split), "anchor", "left").groupBy("key").agg(
        F.collect_list(F.struct("start", "size", "anchor", F.coalesce("split", F.lit(False)).alias("split"))).alias("marks"))
    marked = rows.join(_as_small_as(found, marks), "key").select("key", recurrence.place().alias("doc_id"), "text", "marks")
    runs = found.filter("anchor IS NULL").select("key", "start", "size").unionByName(_later_in_shards(_with_words(marked, window), window))
    return runs.groupBy("key").agg(F.collect_list(F.struct("start", "size")).alias("runs"))


def _as_small_as(found: DataFrame, derived: DataFrame) -> DataFrame:
    """Hint a broadcast of what was ``derived`` from the written ``found`` if that is small: its lists take several times the bytes."""
    return F.broadcast(derived) if written_bytes(found) <= BROADCAST_BYTES // 8 else derived


def dedupe_phrases(docs: DataFrame, window: int = 20) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (words joined by one blank) and ``kept_sha256`` per row of ``docs``.

    Words end at white space and stay unchanged. Each word covered by ``window`` consecutive words that also start
    earlier (smaller ``doc_id``, or same document and earlier) is removed; windows are judged on the input. Null
    and empty texts have no words, shorter ones no window. Rows with the same id and text are one document and
    lose the same words; same id with another text goes by a hash of both. A missing id counts as smallest.
    """
    found = cut_lineage(recurrence.recurring_stretches(recurrence.keyed(docs), window, K))
    # both joins with the texts are in one query and have the same side of texts, so that these are shuffled only once
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    rows = texts.join(_as_small_as(found, later_windows(texts, found, window)), "key", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                out: list[list] = [[], [], [], []]
                for text, gone in zip(utf8(part.column(1)), part.column(2).to_pylist()):
                    words = plain_words(text or b"")
                    kept = words
                    if gone:
                        starts, sizes = (np.array([run[c] for run in gone]) for c in ("start", "size"))
                        flags = covered(starts, sizes + window - 1, len(words))
                        kept = [w for w, f in zip(words, flags.tolist()) if not f]
                    joined = b" ".join(kept)
                    for column, value in zip(out, (len(words), len(words) - len(kept), joined, hashlib.sha256(joined).hexdigest())):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                     pa.array(out[2], pa.binary()).cast(pa.string()), pa.array(out[3], pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return rows.select("doc_id", "text", "runs").mapInArrow(
        run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
