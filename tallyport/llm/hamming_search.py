"""Nearest neighbours by multi-index hashing of learned binary codes.

A rotation of the centred, principal-axis coordinates is learned so that signs lose little (iterative quantisation);
a vector's code is its signs. Codes are split into substrings, and each substring is an index. Two codes
within Hamming radius r differ by at most r // m in one of m substrings, so probing every substring's values
within that few flips finds every code within r. What lies within the radius is ranked by exact distance.

The radius is learned too: the smallest one that on the sample, searched in itself, keeps enough of the true
neighbours. With more rows, neighbours only come closer.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyport.llm.words import sorted_groups
from tallyport.session import cut_lineage

SAMPLE = 10_000
ROW_BLOCK, QUERY_BLOCK = 4096, 2000


class Coder(NamedTuple):
    """``codes``: signs of the rotated offset from ``centre``. Search within ``radius``, over ``cuts`` substrings."""

    centre: np.ndarray
    rotation: np.ndarray
    radius: int
    cuts: tuple[tuple[int, int], ...]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One unsigned 64-bit code per vector; longer vectors use their first 64 principal axes."""
        signs = (vectors - self.centre) @ self.rotation > 0
        return signs.astype(np.uint64) @ (np.uint64(1) << np.arange(signs.shape[1], dtype=np.uint64))


def substrings(bits: int, radius: int) -> tuple[tuple[int, int], ...]:
    """First bit and length of each substring: so many that probing flips at most one bit."""
    parts = max(1, min(bits, radius // 2 + 1))
    edges = [bits * i // parts for i in range(parts + 1)]
    return tuple((a, b - a) for a, b in zip(edges, edges[1:]))


def learn(sample: np.ndarray, neighbours: int = 10, recall: float = 0.97, rounds: int = 30, seed: int = 5) -> Coder:
    """Learn centre, rotation and radius from a sample of at least one vector."""
    centre = sample.mean(axis=0)
    _, _, axes = np.linalg.svd(np.vstack([sample - centre, np.zeros((sample.shape[1], sample.shape[1]))]), full_matrices=False)
    bits = min(64, sample.shape[1])
    basis = axes[:bits].T
    turned = (sample - centre) @ basis
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(rounds):  # signs for the rotation, then the rotation for the signs
        signs = np.where(turned @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(turned.T @ signs)
        rotation = left @ right
    coder = Coder(centre, basis @ rotation, 0, ())
    codes = coder.codes(sample)
    asked = range(0, len(sample), max(1, len(sample) // 400))
    needed = []
    for i in asked:
        distance = ((sample - sample[i]) ** 2).sum(axis=1)
        distance[i] = np.inf
        nearest = np.argsort(distance, kind="stable")[:min(neighbours, len(sample) - 1)]
        needed.extend(np.bitwise_count(codes[nearest] ^ codes[i]).tolist())
    radius = int(np.quantile(needed, recall, method="higher")) if needed else bits
    return coder._replace(radius=radius, cuts=substrings(bits, radius))


class Index:
    """The substring indexes of a block of codes: row numbers in order of each substring's value."""

    def __init__(self, codes: np.ndarray, coder: Coder):
        self.codes, self.coder, self.tables = codes, coder, []
        for first, length in coder.cuts:
            value = self._value(codes, first, length)
            order = np.argsort(value, kind="stable")
            self.tables.append((order, value[order]))

    @staticmethod
    def _value(codes, first: int, length: int):
        return (codes >> np.uint64(first)) & np.uint64((1 << length) - 1)

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Every row whose code is within ``radius``, by probing all substrings."""
        flips = radius // len(self.coder.cuts)
        seen = np.zeros(len(self.codes), bool)
        for (first, length), (order, values) in zip(self.coder.cuts, self.tables):
            own = int(self._value(code, first, length))
            probes = [own ^ sum(1 << b for b in bits) for k in range(min(flips, length) + 1) for bits in combinations(range(length), k)]
            probes = np.array(probes, np.uint64)
            begin, end = np.searchsorted(values, probes, "left"), np.searchsorted(values, probes, "right")
            for a, b in zip(begin.tolist(), end.tolist()):
                seen[order[a:b]] = True
        rows = np.flatnonzero(seen)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= radius]


def usable_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (doubles): one per id, without those that take no part.

    Null, empty and zero vectors, those with null or non-finite components and rows without id are left out, and so are
    vectors of another length than most (the longer on ties): they have no distance to the others. If an id has
    several vectors, the smallest in array order stands for it.
    """
    vector = F.col("vector")
    kept = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.exists("vector", lambda x: x != 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    kept = kept.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    kept = cut_lineage(kept)
    usual = kept.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return kept.filter(F.size("vector") == (usual["n"] if usual else 0))


def nearest(vectors: DataFrame, is_query, neighbours: int = 10, sample: int = SAMPLE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance) of each query's nearest rows.

    ``is_query`` is a condition on ``vec_id``. ``vectors`` as from ``usable_vectors``; all are indexed. The coder is fitted on
    at most ``sample`` of them, the first by hash of the id. Queries and rows meet in blocks. Where a block has fewer rows
    within the radius than asked for, the radius grows there until it has, so every query gets ``neighbours`` rows
    or all. Ties go to the smaller id; a row is never its own neighbour. No rows give no result.
    """
    spark = vectors.sparkSession
    fitted = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").collect()
    schema = "query_id bigint, vec_id bigint, score double"
    if not fitted:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    coder = learn(np.array([r["vector"] for r in fitted]), neighbours)
    rows, queries = vectors.count(), vectors.filter(is_query).count()
    row_blocks, query_blocks = max(1, -(-rows // ROW_BLOCK)), max(1, -(-queries // QUERY_BLOCK))
    block = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    indexed = vectors.withColumn("row_block", block(row_blocks, 1)).withColumn("query_block", spread(query_blocks)).withColumn("side", F.lit(0))
    asked = vectors.filter(is_query).withColumn("query_block", block(query_blocks, 2)).withColumn("row_block", spread(row_blocks)).withColumn("side", F.lit(1))
    tiles = (
        indexed.unionByName(asked).withColumn("tile", F.col("row_block") * query_blocks + F.col("query_block"))
        .select("tile", "side", "vec_id", "vector").repartition("tile").sortWithinPartitions("tile")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "tile"):
            group = group.combine_chunks()
            side, ids = group.column("side").to_numpy(), group.column("vec_id").to_numpy()
            values = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            own, asking = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(own) or not len(asking):
                continue
            row_ids, rows = ids[own], values[own]
            index = Index(coder.codes(rows), coder)
            out: list[list] = [[], [], []]
            for q, code in zip(asking, coder.codes(values[asking])):
                radius = coder.radius
                while True:
                    found = index.within(code, radius)
                    found = found[row_ids[found] != ids[q]]
                    if len(found) >= neighbours or radius >= 64:
                        break
                    radius += 4
                distance = np.sqrt(((rows[found] - values[q]) ** 2).sum(axis=1))
                best = np.lexsort((row_ids[found], distance))[:neighbours]
                out[0].extend([int(ids[q])] * len(best))
                out[1].extend(row_ids[found][best].tolist())
                out[2].extend(distance[best].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        tiles.mapInArrow(run, schema).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
