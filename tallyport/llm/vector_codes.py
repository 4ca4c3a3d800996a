"""Product codes for vectors, learned by Lloyd rounds whose assignment step is a dual-tree search.

Vectors become integers (``floor(scale * x)``) and are cut into ``parts`` consecutive parts; part ``j`` of a vector of
``d`` components holds the components ``i`` with ``floor(i * parts / d) == j`` (equal parts when ``parts`` divides
``d``). Each part position has a codebook of ``entries`` integer vectors, started from that part of the ``entries``
vectors with the smallest ids (ties by their components). A round assigns every part to its codebook's nearest entry
(squared Euclidean distance, ties to the lower index) and replaces each entry by the componentwise ``floor(sum /
count)`` of its parts; entries nobody chose stay. Vectors of different lengths have codebooks of their own.

Assignment, inside each task: a k-d tree over the task's parts (boxes, member sums and counts kept per node) and one
over the entries. A pair of nodes gets the smallest and largest squared distance between their boxes; an entry node
whose smallest distance exceeds the least largest distance of the others is pruned for the whole part node. A part
node left with one entry is assigned whole, its cached sum and count added at once; leaves still holding several
entries are settled by exact integer distances. Every bound is an integer, so nothing is rounded.

Spark's part: tasks send per (length, part, entry) one count and the sums (pre-aggregated, at most ``entries * d`` rows
per length and task), a grouped sum adds them up, and the driver receives only the codebooks (``entries * d``
integers per length), which travel to the next round inside the function.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LEAF = 256


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds only finite, non-null components, with ``ints`` and ``d`` added."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    kept = df.where(F.col(vector).isNotNull() & finite)
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return kept.withColumn("ints", ints).withColumn("d", F.size(vector))


def part_columns(d: int, parts: int = PARTS) -> list[np.ndarray]:
    own = (np.arange(d) * parts) // max(d, 1)
    return [np.flatnonzero(own == j) for j in range(parts)]


class _Tree:
    """A k-d tree over integer points: boxes, sums, counts and members per node."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.lo, self.hi, self.sum, self.count, self.members, self.kids = [], [], [], [], [], []
        self.points = points
        self._build(np.arange(len(points)), leaf)

    def _build(self, members: np.ndarray, leaf: int) -> int:
        node = len(self.lo)
        box = self.points[members]
        self.lo.append(box.min(axis=0))
        self.hi.append(box.max(axis=0))
        self.sum.append(box.sum(axis=0))
        self.count.append(len(members))
        self.members.append(members)
        self.kids.append(None)
        spread = self.hi[node] - self.lo[node]
        if len(members) > leaf and spread.size and spread.max() > 0:
            axis = int(spread.argmax())
            order = members[np.argsort(box[:, axis], kind="stable")]
            half = len(order) // 2
            self.kids[node] = (self._build(order[:half], leaf), self._build(order[half:], leaf))
        return node


def _bounds(lo: np.ndarray, hi: np.ndarray, elo: np.ndarray, ehi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest squared distance between one box and many."""
    gap = np.maximum(0, np.maximum(elo - hi, lo - ehi))
    far = np.maximum(np.abs(hi - elo), np.abs(ehi - lo))
    return (gap * gap).sum(axis=1), (far * far).sum(axis=1)


def assign(points: np.ndarray, entries: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each point (ties to the lower index), and per entry the count and sum of its points.

    Points and entries are integer arrays; the answer equals a brute-force search.
    """
    n, m = points.shape
    k = len(entries)
    chosen = np.empty(n, np.int64)
    counts = np.zeros(k, np.int64)
    sums = np.zeros((k, m), np.int64)
    if n == 0:
        return chosen, counts, sums
    ptree, etree = _Tree(points, leaf), _Tree(entries, 1)
    elo, ehi = np.array(etree.lo), np.array(etree.hi)
    stack = [(0, np.array([0]))]
    while stack:
        node, cands = stack.pop()
        lo, hi = ptree.lo[node], ptree.hi[node]
        while True:
            near, far = _bounds(lo, hi, elo[cands], ehi[cands])
            cands = cands[near <= far.min()]
            inner = [c for c in cands.tolist() if etree.kids[c] is not None]
            if not inner:
                break
            cands = np.array([c for c in cands.tolist() if etree.kids[c] is None] + [g for c in inner for g in etree.kids[c]])
        whole = [int(i) for c in cands.tolist() for i in etree.members[c]]
        if len(whole) == 1:
            e = whole[0]
            chosen[ptree.members[node]] = e
            counts[e] += ptree.count[node]
            sums[e] += ptree.sum[node]
        elif ptree.kids[node] is None:
            own = np.array(sorted(set(whole)))
            members = ptree.members[node]
            diff = points[members][:, None, :] - entries[own][None, :, :]
            best = own[(diff * diff).sum(axis=2).argmin(axis=1)]
            chosen[members] = best
            np.add.at(counts, best, 1)
            np.add.at(sums, best, points[members])
        else:
            for kid in ptree.kids[node]:
                stack.append((kid, cands))
    return chosen, counts, sums


def _matrix(ints: pd.Series, d: int) -> np.ndarray:
    if len(ints) == 0:
        return np.empty((0, d), np.int64)
    return np.stack([np.asarray(v, np.int64) for v in ints]) if d else np.empty((len(ints), 0), np.int64)


def _totals(books: dict[int, list[np.ndarray]]):
    """Task function: per (length, part, entry) the count and the sums of the parts assigned there."""

    def run(frames):
        for frame in frames:
            rows = []
            for d, group in frame.groupby("d", sort=True):
                d = int(d)
                points = _matrix(group["ints"], d)
                for j, cols in enumerate(part_columns(d)):
                    _, counts, sums = assign(points[:, cols], books[d][j])
                    for e in np.flatnonzero(counts).tolist():
                        rows.append((d, j, e, int(counts[e]), sums[e].tolist()))
            yield pd.DataFrame(rows, columns=["d", "part", "entry", "n", "sums"])

    return run


def _codes(books: dict[int, list[np.ndarray]], keep: list[str]):
    """Task function: each row's code and error under the final codebooks."""

    def run(frames):
        for frame in frames:
            codes = np.empty(len(frame), object)
            errors = np.zeros(len(frame), np.int64)
            for d, group in frame.groupby("d", sort=True):
                d = int(d)
                points = _matrix(group["ints"], d)
                where = frame.index.get_indexer(group.index)
                picked = []
                for j, cols in enumerate(part_columns(d)):
                    chosen, _, _ = assign(points[:, cols], books[d][j])
                    diff = points[:, cols] - books[d][j][chosen] if len(cols) else np.zeros((len(group), 0), np.int64)
                    errors[where] += (diff * diff).sum(axis=1)
                    picked.append(chosen)
                stacked = np.stack(picked, axis=1) if picked else np.zeros((len(group), 0), np.int64)
                codes[where] = ["".join(f"{c:02x}" for c in row) for row in stacked.tolist()]
            out = frame[keep].copy()
            out["code"] = codes
            out["error"] = errors
            yield out

    return run


def _first_books(kept: DataFrame, entries: int) -> dict[int, list[np.ndarray]]:
    """Per length, the parts of the ``entries`` vectors with the smallest ids: a top-k per task, then per length."""
    rank = Window.partitionBy("d").orderBy("vec_id", "ints")
    local = kept.select("d", "vec_id", "ints").withColumn("p", F.spark_partition_id())
    first = (local.withColumn("r", F.row_number().over(Window.partitionBy("d", "p").orderBy("vec_id", "ints")))
             .where(F.col("r") <= entries)
             .withColumn("r", F.row_number().over(rank)).where(F.col("r") <= entries))
    books: dict[int, list[np.ndarray]] = {}
    for row in first.orderBy("d", "r").collect():
        books.setdefault(row["d"], []).append(row["ints"])
    return {d: [np.array(vs, np.int64).reshape(len(vs), d)[:, cols] for cols in part_columns(d)] for d, vs in books.items()}


def books_digest(book: list[np.ndarray]) -> str:
    """sha256 of all entries' components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for part in book for v in part.ravel().tolist()).encode()).hexdigest()


def train_codes(df: DataFrame, vector: str = "embedding", entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, dict]:
    """Codebooks by ``rounds`` Lloyd rounds and every usable row's code; returns the rows and the codebooks per length.

    Rows keep their columns other than ``ints``, ``d``, ``code``, ``error`` (those are replaced) and gain ``code``
    (two hex digits per part, in part order), ``error`` (squared distance to the chosen entries, summed) and ``d``.
    Rows with a null vector, or a null or non-finite component, are left out; an empty vector is a code of
    ``parts`` zeros with error 0. Repeated rows get equal codes. An empty table gives no rows and no codebooks.
    Fewer usable vectors of a length than ``entries`` make a shorter codebook.
    """
    base = df.drop("ints", "d", "code", "error")
    kept = usable(base, vector)
    books = _first_books(kept, entries)
    ints_schema = "d int, part int, entry int, n long, sums array<long>"
    for _ in range(rounds):
        if not books:
            break
        totals = kept.select("d", "ints").mapInPandas(_totals(books), ints_schema)
        summed = (totals.select("d", "part", "entry", "n", F.posexplode("sums").alias("at", "s"))
                  .groupBy("d", "part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
        for row in summed.collect():
            book = books[row["d"]][row["part"]]
            book[row["entry"], row["at"]] = row["s"] // row["n"]
    keep = [c for c in kept.columns if c != "ints"]
    fields = [f for f in kept.schema.fields if f.name != "ints"]
    schema = T.StructType(fields + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = kept.mapInPandas(_codes(books, keep), schema)
    return coded, books
