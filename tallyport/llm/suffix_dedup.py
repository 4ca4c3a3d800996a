"""Finds long repeated passages with sparse suffix arrays.

Of all suffixes of all texts only those are kept that begin at a minimiser: the smallest word k-gram of a stretch,
which equal passages select alike. Kept suffixes are sorted by their first words and compared with their
neighbours; a suffix that differs from both begins no repeat. From the others the match is extended to the
left and right: every window of the least length that holds the minimiser is sorted and compared with its
neighbours in turn, and windows that agree with one merge into passages as long as they go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm import recurrence
from tallyport.llm.columns import small
from tallyport.llm.words import WordHashes, plain_words, signed, utf8, window_hashes
from tallyport.session import cut_lineage

K = 16


def _extended(texts: DataFrame, least: int) -> DataFrame:
    """``hash``, ``doc_id``, ``key`` and ``start`` of every window of ``least`` words that holds a recurring minimiser."""
    marks = cut_lineage(recurrence.recurring_anchors(texts, least, K))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for begin in range(0, batch.num_rows, 100):
                part = batch.slice(begin, 100)
                out: list[list[np.ndarray]] = [[], [], [], []]
                for key, doc, text, places in zip(
                        part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), part.column(3).to_pylist()):
                    hashes = memo.of(plain_words(text))
                    _, first, size = recurrence.anchor_starts(hashes, least, K)
                    first, size = first[np.array(places)], size[np.array(places)]
                    starts = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                    row = (signed(window_hashes(hashes, least)[starts]), np.full(len(starts), doc), np.full(len(starts), key), starts.astype(np.int32))
                    for column, values in zip(out, row):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["hash", "doc_id", "key", "start"])

    return texts.join(small(marks), "key").select("key", "doc_id", "text", "places").mapInArrow(
        run, "hash bigint, doc_id bigint, key bigint, start int")


def _without_repeats(windows: DataFrame) -> DataFrame:
    """Sorted windows without rows that equal the one before: rows of the input that repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            new = np.concatenate([[last is None or any(c[0] != v for c, v in zip(columns, last))],
                                  np.any([c[1:] != c[:-1] for c in columns], axis=0)])
            last = [c[-1] for c in columns]
            yield batch.filter(pa.array(new))

    return windows.mapInArrow(run, windows.schema)


def _agreeing(windows: DataFrame) -> DataFrame:
    """``key``, ``start`` and the neighbours' documents ``before`` and ``after`` of windows that agree with a neighbour.

    ``windows`` comes sorted. A task holds two rows over from batch to batch, never a group.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def compared(columns, final: bool):
            hashes, doc, key, start = columns
            same = hashes[1:] == hashes[:-1]
            before, after = np.concatenate([[False], same]), np.concatenate([same, [False]])
            keep = before | after
            keep[0] &= first_batch  # otherwise it was decided with the rows before it
            keep[-1] &= final
            rows = np.flatnonzero(keep)
            left = pa.array(doc[rows - 1], mask=~before[rows])
            right = pa.array(doc[np.minimum(rows + 1, len(doc) - 1)], mask=~after[rows])
            return pa.RecordBatch.from_arrays([pa.array(key[rows]), pa.array(start[rows]), left, right], ["key", "start", "before", "after"])

        first_batch = True
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
            if len(columns[0]) > 1:
                yield compared(columns, False)
                first_batch = first_batch and len(columns[0]) < 2
            held = [c[-2:] for c in columns]
        if held is not None and len(held[0]) > 1:
            yield compared(held, True)

    return windows.mapInArrow(run, "key bigint, start int, before bigint, after bigint")


def repeated_passages(docs: DataFrame, least: int = 50) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_repeated``, ``spans`` and ``partners`` per row of ``docs``.

    A word is repeated if it lies in ``least`` consecutive words that start at least twice in the corpus, in another
    document or again in the same one. ``spans`` are the maximal passages of such words: first word and end
    (exclusive). ``partners`` are the documents next to the row, by id, among those that have one of its windows.
    Words end at white space and stay unchanged. Null and empty texts have none, shorter ones no passage. Rows with
    the same id and text are one document. A missing id never is a partner.
    """
    # rows that repeat with their id are one document: one of their windows at each place goes through the search
    texts = recurrence.keyed(docs.select("doc_id", "text"))
    windows = _extended(texts, least).repartition("hash").sortWithinPartitions("hash", "doc_id", "key", "start")
    windows = _without_repeats(windows)
    per_doc = _agreeing(windows).groupBy("key").agg(
        F.collect_list("start").alias("starts"),
        F.array_union(F.collect_set("before"), F.collect_set("after")).alias("partners"))
    per_doc = cut_lineage(per_doc)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).join(small(per_doc), "key", "left")
    span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc, text, starts, partners in zip(
                    batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                spans: list[dict] = []
                for start in sorted(starts or ()):
                    if spans and start <= spans[-1]["end"]:
                        spans[-1]["end"] = start + least
                    else:
                        spans.append({"first": start, "end": start + least})
                row = (len(plain_words(text or b"")), sum(s["end"] - s["first"] for s in spans), spans,
                       sorted(p for p in partners or () if p != doc and p != -(2**63)))
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], span),
                 pa.array(out[3], pa.list_(pa.int64()))], ["doc_id", "n_words", "n_repeated", "spans", "partners"])

    kind = dict(docs.dtypes)["doc_id"]
    return rows.select("doc_id", "text", "starts", "partners").mapInArrow(
        run, f"doc_id {kind}, n_words bigint, n_repeated bigint, spans array<struct<first:int,end:int>>, partners array<bigint>")
