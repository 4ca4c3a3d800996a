"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of consecutive words whose smallest period ``q`` (words ``q`` apart are equal) leaves it at least
``max(MIN_LENGTH, 3 q)`` words long and that no neighbouring word extends while keeping period ``q``.

Method, per document inside the tasks of ``mapInArrow`` (documents are independent, so Spark's partitions carry the
work and nothing is shuffled):

* periods up to ``DIRECT_PERIODS`` by direct lag scans: for each lag ``q`` the words equal to the word ``q`` later form
  maximal blocks; a block of ``b`` such words is a stretch of ``b + q`` words with period ``q``. The scans run over a
  whole slice of documents at once.
* longer periods by scales ``[P, 2P)`` with ``P`` doubling from ``DIRECT_PERIODS + 1``: hashes of ``GRAM``-word grams,
  window minima over ``P`` gram starts (ties to the leftmost). Inside a run of period ``q >= P`` a window and the window
  ``q`` later hold the same grams, so their minima are the same gram at distance ``q``: pairs of equal minimizers at a
  distance ``d`` in the scale's range seed a lag scan at ``d`` that is extended left and right from the seed.
  Minima that lie, with ``2P + max(GRAM, period)`` words after them, inside a stretch of a shorter period found
  before are passed over: a run of period ``d`` seeded there would have a smaller period (see ``_seeds``).
* a stretch found at several lags is one run with the smallest of them (a longer period of a stretch of length ``>= 3q``
  is a multiple of its smallest one, which finds the same stretch).

Cost is linear in the words for ordinary texts; inside a long stretch of one short unit only the minima near its end
pair, so such a document costs about the square of the largest period scanned at the top scale.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyport.llm.words import mixed, window_hashes

# Fixed values of the definition: a run is at least this long, and at least three periods.
MIN_LENGTH = 24
MIN_PERIODS = 3
#: periods up to this are found by scanning each lag; longer ones by minimizers
DIRECT_PERIODS = 32
#: words per hashed gram at the minimizer scales (must not exceed DIRECT_PERIODS + 1)
GRAM = 4
#: words handed to one pass over a slice of documents
SLICE_WORDS = 2_000_000

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                    T.StructField("period", T.LongType())])
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def _blocks(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal blocks of true values."""
    edges = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _long_enough(length: int, period: int) -> bool:
    return length >= max(MIN_LENGTH, MIN_PERIODS * period)


def direct_runs(ids: np.ndarray, doc: np.ndarray, periods: int = DIRECT_PERIODS) -> list[tuple[int, int, int, int]]:
    """(document, start, end, period) of every stretch with a period up to ``periods``, for words of many documents.

    ``ids`` are word numbers of all documents one after another, ``doc`` the document of each word.
    """
    found = []
    for q in range(1, periods + 1):
        if len(ids) <= q:
            break
        same = (ids[:-q] == ids[q:]) & (doc[:-q] == doc[q:])
        starts, ends = _blocks(same)
        keep = ends - starts + q >= max(MIN_LENGTH, MIN_PERIODS * q)
        for a, b in zip(starts[keep].tolist(), ends[keep].tolist()):
            found.append((int(doc[a]), a, b + q, q))
    return found


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys (van Herk / Gil-Werman), ``len(keys) - width + 1`` of them."""
    m = len(keys)
    blocks = -(-m // width)
    padded = np.concatenate((keys, np.full(blocks * width - m, _MAX, np.uint64))).reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:m - width + 1], ahead[width - 1:m])


def _extend(ids: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The block ``[a, b)`` of positions around ``i`` whose word equals the one ``d`` later."""
    n = len(ids)
    a, step = i, 64
    while a > 0:
        lo = max(0, a - step)
        differ = np.flatnonzero(ids[lo:a] != ids[lo + d:a + d])
        if len(differ):
            a = lo + int(differ[-1]) + 1
            break
        a, step = lo, step * 2
    b, step = i, 64
    while b < n - d:
        hi = min(n - d, b + step)
        differ = np.flatnonzero(ids[b:hi] != ids[b + d:hi + d])
        if len(differ):
            b += int(differ[0])
            break
        b, step = hi, step * 2
    return a, b


def _seeds(grams: np.ndarray, low: int, high: int, shorter: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of pairs of equal window minima ``low <= d <= high`` apart, windows of ``low`` grams.

    Minima deep inside a stretch of a shorter period (``shorter``) pair with nobody: a run of period ``d`` seeded there
    would share ``d`` plus that period of words with the stretch and so have a smaller period (Fine and Wilf); its seed
    from the window at its own start lies outside.
    """
    if len(grams) < low:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys = ((grams >> np.uint64(32)) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    chosen = np.unique(sliding_minimum(keys, low))
    at = (chosen & np.uint64(0xFFFFFFFF)).astype(np.int64)
    value = chosen >> np.uint64(32)
    deep = np.zeros(len(at), bool)
    for start, end, q in shorter:
        deep |= (at >= start) & (at + high + max(GRAM, q) <= end)
    at, value = at[~deep], value[~deep]
    order = np.lexsort((at, value))
    at, value = at[order], value[order]
    firsts, gaps = [], []
    for t in range(1, len(at)):
        same = value[:-t] == value[t:]
        gap = at[t:] - at[:-t]
        if not np.any(same & (gap <= high)):
            break
        pick = same & (gap >= low) & (gap <= high)
        firsts.append(at[:-t][pick])
        gaps.append(gap[pick])
    if not firsts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(firsts), np.concatenate(gaps)


def scaled_runs(ids: np.ndarray, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, period) of stretches with periods above ``DIRECT_PERIODS``; ``found`` holds the shorter ones."""
    n = len(ids)
    runs = list(found)
    fresh = []
    low = DIRECT_PERIODS + 1
    if n < MIN_PERIODS * low:
        return fresh
    grams = window_hashes(mixed(ids.astype(np.uint64) + np.uint64(1)), GRAM)
    while low <= n // MIN_PERIODS:
        high = min(2 * low - 1, n // MIN_PERIODS)
        firsts, gaps = _seeds(grams, low, high, list(runs))
        if len(firsts):
            order = np.lexsort((firsts, gaps))
            firsts, gaps = firsts[order], gaps[order]
            reached, last_d = -1, -1
            for i, d in zip(firsts.tolist(), gaps.tolist()):
                if d != last_d:
                    reached, last_d = -1, d
                elif i < reached:
                    continue
                if ids[i] != ids[i + d]:
                    continue
                a, b = _extend(ids, i, d)
                reached = b
                if _long_enough(b - a + d, d):
                    fresh.append((a, b + d, d))
                    runs.append((a, b + d, d))
        low *= 2
    return fresh


def doc_runs(ids: np.ndarray, direct: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one document, by start, then period."""
    shortest: dict[tuple[int, int], int] = {}
    for a, e, q in direct + scaled_runs(ids, direct):
        if shortest.get((a, e), q + 1) > q:
            shortest[(a, e)] = q
    return sorted(((a, e - a, q) for (a, e), q in shortest.items()), key=lambda r: (r[0], r[2]))


def summary(words: list[str], runs: list[tuple[int, int, int]]) -> dict:
    """The best run, the digest of all runs and the words left when each run keeps only its first period."""
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    dropped = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.cumsum(dropped[:-1]) == 0
    collapsed = " ".join(w for w, k in zip(words, kept.tolist()) if k)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return {
        "n_runs": len(runs),
        "best": best,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed": collapsed,
    }


def _batches(batches, words_at: int, names: list[str]):
    for batch in batches:
        lists = batch.column(words_at)
        total = len(lists)
        begin = 0
        while begin < total:
            end, size = begin, 0
            offsets = lists.offsets.to_numpy()
            while end < total and (end == begin or size + offsets[end + 1] - offsets[end] <= SLICE_WORDS):
                size += offsets[end + 1] - offsets[end]
                end += 1
            part = batch.slice(begin, end - begin)
            yield _runs_of(part, words_at, names)
            begin = end


def _runs_of(batch: pa.RecordBatch, words_at: int, names: list[str]) -> pa.RecordBatch:
    lists = batch.column(words_at)
    flat = lists.flatten().fill_null("")
    ids = np.asarray(flat.dictionary_encode().indices.to_numpy(zero_copy_only=False), np.int64) if len(flat) else np.empty(0, np.int64)
    counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    doc = np.repeat(np.arange(len(counts)), counts)
    direct: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    for d, a, e, q in direct_runs(ids, doc):
        base = bounds[d]
        direct[d].append((a - base, e - base, q))
    words = flat.to_pylist()
    run_lists, collapsed = [], []
    for d in range(len(counts)):
        lo, hi = bounds[d], bounds[d + 1]
        runs = doc_runs(ids[lo:hi], direct[d])
        run_lists.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
        collapsed.append(summary(words[lo:hi], runs)["collapsed"])
    columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name not in names]
    kept = [name for name in batch.schema.names if name not in names]
    return pa.RecordBatch.from_arrays(
        columns + [pa.array(run_lists, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                   pa.array(collapsed, pa.string())],
        names=kept + names,
    )


def periodic_runs(df: DataFrame, words: str = "words") -> DataFrame:
    """Every run of each row's ``words`` (array of strings), and the words joined with each run cut to one period.

    Adds ``runs`` (array of start, length, period; by start, then period; words numbered from 0) and ``collapsed`` (the
    words outside every run's part after its first period, joined by one blank). Input columns named ``runs`` or
    ``collapsed`` are replaced; all others pass through. A null or empty array has no runs and an empty ``collapsed``;
    a null word counts as an empty word. Repeated rows give equal
    results; an empty table gives an empty one.
    """
    names = ["runs", "collapsed"]
    fields = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType(fields + [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    words_at = df.columns.index(words)
    return df.mapInArrow(lambda batches: _batches(batches, words_at, names), schema)


def best_run(runs: list[dict]) -> dict | None:
    """The run with the greatest length per period (exact), ties to the smallest start, then period."""
    if not runs:
        return None
    return min(runs, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]))
