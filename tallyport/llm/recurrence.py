"""Word windows that recur anywhere, through anchors that texts select by their content.

Every window of ``window`` words has one anchor, its smallest ``k``-gram by hash, so equal windows have equal anchors.
Only anchors are shuffled in full, about one for each ``(window - k) / 2`` words; windows are looked at where
their anchor recurs. The windows of one anchor start at consecutive words; together they are a stretch. A stretch whose
words also occur earlier, as copies have them by thousands, needs no further look: all its windows start earlier too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.llm.words import WordHashes, mixed, plain_words, signed, span_hashes, utf8, window_hashes


def place() -> Column:
    """``doc_id`` for comparisons: a missing one counts as smaller than all others."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))


def keyed(docs: DataFrame) -> DataFrame:
    """``key``, ``doc_id`` and ``text`` of rows with text, one for each id and text; ``key`` names both.

    A missing id counts as smaller than all others.
    """
    return docs.filter("text IS NOT NULL").select(
        F.xxhash64("doc_id", "text").alias("key"), place().alias("doc_id"), "text")


def anchor_starts(hashes: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of anchors, and the first and the number of the windows of each. ``hashes`` are of words."""
    grams = window_hashes(hashes, k)
    span = window - k + 1
    if len(grams) < span:
        return (np.empty(0, np.int64),) * 3
    views = np.lib.stride_tricks.sliding_window_view(grams, span)
    anchor = views.argmin(axis=1) + np.arange(len(views))
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    return anchor[first], first, np.diff(np.concatenate([first, [len(anchor)]]))


def recurring_anchors(docs: DataFrame, window: int, k: int) -> DataFrame:
    """``key`` and ``places`` of anchors (by number within their document) that occur at least twice.

    Anchors come sorted and each is compared with its neighbours, so a task holds one row, never a group.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for begin in range(0, len(keys), 500):
                anchors, owners, numbers = [], [], []
                for key, text in zip(keys[begin:begin + 500], utf8(batch.column(1).slice(begin, 500))):
                    hashes = memo.of(plain_words(text))
                    at, _, _ = anchor_starts(hashes, window, k)
                    if len(at):
                        anchors.append(window_hashes(hashes, k)[at])
                        owners.append(np.full(len(at), key))
                        numbers.append(np.arange(len(at), dtype=np.int32))
                if anchors:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(np.concatenate(anchors))), pa.array(np.concatenate(owners)), pa.array(np.concatenate(numbers))],
                        ["anchor", "key", "number"])

    def recur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            same_before = False
            if held is not None:
                columns = [np.concatenate([h, c]) for h, c in zip(held[0], columns)]
                same_before = held[1]
            same = columns[0][1:] == columns[0][:-1]
            before, after = np.concatenate([[same_before], same]), np.concatenate([same, [False]])
            keep = before | after
            keep[-1] = False
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns[1:]], ["key", "number"])
            held = [c[-1:] for c in columns], bool(before[-1])
        if held is not None and held[1]:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0][1:]], ["key", "number"])

    found = docs.select("key", "text").mapInArrow(find, "anchor bigint, key bigint, number int")
    ordered = found.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(recur, "key bigint, number int").groupBy("key").agg(F.collect_set("number").alias("places"))


def stretches(docs: DataFrame, window: int, k: int) -> DataFrame:
    """``anchor``, ``stretch`` (hash of its words), ``doc_id``, ``key``, ``start`` and ``size`` (windows) of all stretches of ``docs``.

    If a stretch of the same words is among the texts of one slice of a batch before it, its ``size`` is negative and a value
    of its own stands for the anchor, so that a passage or word pair of very many texts does not meet in one place.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                texts = dict(zip(zip(part.column(1).to_pylist(), part.column(0).to_pylist()), utf8(part.column(2))))
                out: list[list[np.ndarray]] = [[] for _ in range(6)]
                for doc, key in sorted(texts):
                    hashes = memo.of(plain_words(texts[doc, key]))
                    at, first, size = anchor_starts(hashes, window, k)
                    if len(at):
                        row = (window_hashes(hashes, k)[at], span_hashes(hashes, first, size + window - 1), np.full(len(at), doc),
                               np.full(len(at), key), first.astype(np.int32), size.astype(np.int32))
                        for column, values in zip(out, row):
                            column.append(values)
                if out[0]:
                    anchor, stretch, doc, key, start, size = map(np.concatenate, out)
                    later = np.ones(len(stretch), bool)
                    later[np.unique(stretch, return_index=True)[1]] = False
                    size[later] *= -1
                    anchor[later] = mixed(mixed(key[later].view(np.uint64)) + start[later].astype(np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in (signed(anchor), signed(stretch), doc, key, start, size)],
                        ["anchor", "stretch", "doc_id", "key", "start", "size"])

    return docs.select("key", "doc_id", "text").mapInArrow(find, "anchor bigint, stretch bigint, doc_id bigint, key bigint, start int, size int")


def recurring_stretches(docs: DataFrame, window: int, k: int) -> DataFrame:
    """``key``, ``start`` and ``size`` (windows) of stretches that may hold a repeated window; ``docs`` as from ``keyed``.

    Those whose words start earlier in another stretch have no ``anchor``. The others are the first of their words, and
    another stretch of different words has their ``anchor``. Earlier is what is smaller by ``doc_id``, ``key`` and ``start``.
    Stretches come sorted by anchor; a task holds two rows over from batch to batch, never a group.
    """
    def told(columns: list[np.ndarray], rows: np.ndarray, first: bool) -> pa.RecordBatch:
        anchor, _, _, key, start, size = (c[rows] for c in columns)
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(start), pa.array(size), pa.array(anchor, mask=np.full(len(rows), not first))], ["key", "start", "size", "anchor"])

    def recur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = held = None  # the row before; an anchor's first row, until a stretch of other words has that anchor
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            sure = columns[5] < 0
            yield told([*columns[:5], -columns[5]], np.flatnonzero(sure), False)
            if sure.all():
                continue
            columns = [c[~sure] for c in columns]
            before = [np.concatenate([c[:1] if last is None else l, c[:-1]]) for c, l in zip(columns, last or columns)]
            changed = [c != b for c, b in zip(columns[:5], before)]
            for flags in changed:
                flags[0] |= last is None
            new_anchor, again = changed[0], ~np.any(changed, axis=0)  # again: a row of the input that repeats
            new = new_anchor | changed[1]
            yield told(columns, np.flatnonzero(~new & ~again), False)
            firsts, opens = [c[new] for c in columns], new_anchor[new]
            if held is not None:
                firsts, opens = [np.concatenate([h, f]) for h, f in zip(held, firsts)], np.concatenate([[True], opens])
            # the first row of an anchor counts if the next first row has the same anchor
            keep = ~opens
            keep[:-1] |= ~opens[1:]
            held = [f[-1:] for f in firsts] if len(opens) and opens[-1] else None
            yield told(firsts, np.flatnonzero(keep), True)
            last = [c[-1:] for c in columns]

    ordered = stretches(docs, window, k).repartition("anchor").sortWithinPartitions("anchor", "stretch", "doc_id", "key", "start")
    return ordered.mapInArrow(recur, "key bigint, start int, size int, anchor bigint")
