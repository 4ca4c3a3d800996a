"""Joins documents by Jaccard similarity of their word shingles, with signature trees.

1. Every document gets its set of shingle hashes and a signature: a bitmap with four to eight bits for each of
   them. Documents with equal sets are one class from here on.
2. Two sets that are similar enough share one of the first few shingles in any common order. With rarely
   used shingles first, these few lead together what may be similar and little else: a ward for each shingle
   that two classes share. Stretches of a ward without a fitting neighbour in size fall away.
3. A first round links each class with the smallest one of its ward, which settles most copies.
4. Wards that still hold several components get a signature tree over their classes in order of size: nodes
   hold the OR of the bitmaps below, the range of sizes and the range of components. Two trees (or one
   with itself) are walked together, and a pair of nodes is left as soon as sizes, the largest possible overlap
   or a single common component rule out that anything new lies below. Pairs of leaves that remain are
   compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.columns import small
from tallyport.llm.components import components
from tallyport.llm.words import WordHashes, mixed, plain_words, signed, sorted_groups, utf8, window_hashes
from tallyport.session import cut_lineage

SKETCH_BITS = 18
TILE = 1000
FANOUT = 4


def shingle_set(text: bytes, k: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of ``k`` consecutive words; one of all words if there are fewer, none without."""
    words = plain_words(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(memo.of(words), min(k, len(words))) + np.uint64(min(k, len(words)) - k & 0xFF))


def _bits(n: int) -> int:
    return 1 << max(6, int(4 * n - 1).bit_length())


def signature(tokens: np.ndarray) -> np.ndarray:
    """Bitmap of the hashes, as bytes; an eighth to a quarter of the bits are set."""
    bits = _bits(len(tokens))
    flags = np.zeros(bits, np.uint8)
    flags[(tokens % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(flags)


def fewest_common(a, b, percent: int):
    """Smallest intersection of sets of ``a`` and ``b`` with 100 * common >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """So many first shingles that a similar set, of any fitting size, has one of them."""
    return n - -(-percent * n // 100) + 1


def _sketch(docs: DataFrame, k: int) -> np.ndarray:
    """How many document shingles fall to each slot: a table of fixed size, to tell common shingles from rare ones.

    It only orders shingles. Whatever it says, no similar pair is lost.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, counts = WordHashes(), np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                sets = [shingle_set(text or b"", k, memo) for text in utf8(batch.column(0).slice(begin, 200))]
                slots = np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)
                counts += np.bincount(slots.astype(np.int64), minlength=1 << SKETCH_BITS)
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], ["slot", "n"])

    rows = docs.select("text").mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    out[rows["slot"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def _profiles(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id``, set size ``n``, ``digest`` of the set, ``prefix`` (rarest shingles) and ``sig`` per row."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(_sketch(docs, k), 2**32 - 1).astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, common = WordHashes(), shared.value
        for batch in batches:
            ns, digests, prefixes, sigs = [], [], [], []
            for text in utf8(batch.column(1)):
                tokens = shingle_set(text or b"", k, memo)
                n = len(tokens)
                ns.append(n)
                digests.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                order = np.lexsort((tokens, common[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
                prefixes.append(signed(tokens[order[:prefix_length(n, percent)]]) if n else np.empty(0, np.int64))
                sigs.append(signature(tokens).tobytes() if n else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int32()), pa.array(digests, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                ["doc_id", "n", "digest", "prefix", "sig"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n int, digest binary, prefix array<bigint>, sig binary")


def _wards(shingles: DataFrame, percent: int) -> DataFrame:
    """``ward``, ``id``, ``n``: classes that share a shingle of their prefixes, cut where sizes leave a gap.

    ``shingles`` (``token``, ``n``, ``id``) comes partitioned by token and sorted by all three. One row is held over
    between batches, never a group.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, whether it already had a fitting neighbour, and its ward
        for batch in batches:
            if not batch.num_rows:
                continue
            token, n, doc = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("token", "n", "id"))
            if held is not None:
                token, n, doc = (np.concatenate([[h], x]) for h, x in zip(held[:3], (token, n, doc)))
            near = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])
            before = np.concatenate([[held is not None and held[3]], near])
            after = np.concatenate([near, [False]])
            # a ward is named by its shingle and the size it begins with
            begins = np.flatnonzero(~before)
            first = np.searchsorted(begins, np.arange(len(n)), "right") - 1
            start = np.where(first >= 0, n[begins[np.maximum(first, 0)]] if len(begins) else 0, held[4] if held else 0)
            ward = signed(mixed(token.view(np.uint64) + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            keep = before | after
            keep[-1] = False  # the last row waits for what follows
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(ward[keep]), pa.array(doc[keep]), pa.array(n[keep], pa.int32())], ["ward", "id", "n"])
            held = (token[-1], n[-1], doc[-1], bool(before[-1]), int(start[-1]))
        if held is not None and held[3]:
            ward = signed(mixed(np.array([held[0]], np.int64).view(np.uint64) + np.array([held[4]], np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ward), pa.array([int(held[2])], pa.int64()), pa.array([int(held[1])], pa.int32())], ["ward", "id", "n"])

    return shingles.mapInArrow(run, "ward bigint, id bigint, n int")


class Tree:
    """A signature tree over classes in order of size: levels of nodes, each the OR of ``FANOUT`` below."""

    def __init__(self, n: np.ndarray, component: np.ndarray, bitmaps: np.ndarray, filled: np.ndarray):
        # filled: bits set in each leaf, and tokens that fell on a bit already set, bound what one bit can hide
        self.levels = [(n, n, component, component, bitmaps, filled)]
        while len(self.levels[-1][0]) > 1:
            low, high, first, last, maps, most = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((
                np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(first, at),
                np.maximum.reduceat(last, at), np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(most, at)))


def traverse(a: Tree, b: Tree, percent: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves of two trees that neither size, overlap nor component rule out."""
    i, j = len(a.levels) - 1, len(b.levels) - 1
    x, y = np.array([0]), np.array([0])
    while True:
        low_a, high_a, first_a, last_a, maps_a, set_a = a.levels[i]
        low_b, high_b, first_b, last_b, maps_b, set_b = b.levels[j]
        kept = []
        for start in range(0, len(x), 4096):
            u, v = x[start:start + 4096], y[start:start + 4096]
            keep = (100 * np.minimum(high_a[u], high_b[v]) >= percent * np.maximum(low_a[u], low_b[v]))
            keep &= ~((first_a[u] == last_a[u]) & (first_b[v] == last_b[v]) & (first_a[u] == first_b[v]))
            if same and i == j:
                keep &= u <= v if i else u < v
            u, v = u[keep], v[keep]
            # of the bits a leaf below u has set, at least those beyond the common ones are missing in the other side;
            # every missing bit is a missing shingle, and only so many may be missing
            common = np.bitwise_count(maps_a[u] & maps_b[v]).sum(axis=1, dtype=np.int64)
            na, nb = high_a[u], high_b[v]
            # most shingles that the larger side may miss, at the smallest fitting size; one more for rounding
            spare_a = na - fewest_common(na, np.maximum(low_b[v], -(-percent * na // 100)), percent) + 1
            spare_b = nb - fewest_common(nb, np.maximum(low_a[u], -(-percent * nb // 100)), percent) + 1
            possible = (set_a[u] - common <= spare_a) & (set_b[v] - common <= spare_b)
            kept.append((u[possible], v[possible]))
        x, y = np.concatenate([p[0] for p in kept]), np.concatenate([p[1] for p in kept])
        if i == 0 and j == 0 or not len(x):
            return (x, y) if i == 0 and j == 0 else (np.empty(0, np.int64), np.empty(0, np.int64))
        # go down in the taller tree, or in both
        go_a, go_b = i >= j and i > 0, j >= i and j > 0
        if go_a:
            below = (x[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            y = np.repeat(y, FANOUT)
            fits = below < len(a.levels[i - 1][0])
            x, y, i = below[fits], y[fits], i - 1
        if go_b:
            below = (y[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            x = np.repeat(x, FANOUT)
            fits = below < len(b.levels[j - 1][0])
            x, y, j = x[fits], below[fits], j - 1


def _folded(sig: bytes, size: int) -> np.ndarray:
    """A bitmap brought to ``size`` bytes: a hash modulo more bits, modulo fewer bits, is the hash modulo fewer."""
    own = np.frombuffer(sig, np.uint8)
    return np.bitwise_or.reduce(own.reshape(-1, size), axis=0)


def _tree_of(n: np.ndarray, component: np.ndarray, sigs: list[bytes], size: int) -> Tree:
    maps = np.stack([_folded(s, size) for s in sigs])
    return Tree(n, component, maps, np.bitwise_count(maps).sum(axis=1, dtype=np.int64))


def _ward_pairs(wards: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of classes in different components that the trees of each tile leave open.

    ``wards`` (``tile``, ``side``, ``n``, ``id``, ``component``, ``sig``) comes partitioned by tile and sorted. A tile holds one
    block of a ward (side 0), or two different ones (sides 0 and 1), so its size is bounded.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "tile"):
            side, n, ids, component = (group.column(c).to_numpy() for c in ("side", "n", "id", "component"))
            n, sigs = n.astype(np.int64), group.column("sig").to_pylist()
            size = min(map(len, sigs))
            own, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            tree = _tree_of(n[own], component[own], [sigs[i] for i in own], size) if len(own) else None
            if tree is None:
                continue
            if not len(other):
                x, y = traverse(tree, tree, percent, True)
                a, b = own[x], own[y]
            else:
                x, y = traverse(tree, _tree_of(n[other], component[other], [sigs[i] for i in other], size), percent, False)
                a, b = own[x], other[y]
            new = component[a] != component[b]
            a, b = ids[a[new]], ids[b[new]]
            for start in range(0, len(a), 50_000):
                part = slice(start, start + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a[part], b[part])), pa.array(np.maximum(a[part], b[part]))], ["a", "b"])

    return wards.mapInArrow(run, "a bigint, b bigint")


def _verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs`` whose whole sets are similar enough, with ``common``. Pairs meet at their smaller id."""
    ids = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = docs.select("doc_id", "text").join(small(ids), "doc_id", "left_semi")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            sets = [shingle_set(t or b"", k, memo).tobytes() for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "tokens"])

    sets = cut_lineage(texts.mapInArrow(tokens, "doc_id bigint, tokens binary"))
    both = (
        pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("tokens_b")), "b")
        .join(sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found, common = [], []
            for i, (s, t) in enumerate(zip(left, right)):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                shared = len(np.intersect1d(s, t, assume_unique=True))
                if shared and shared >= fewest_common(len(s), len(t), percent):
                    found.append(i)
                    common.append(shared)
            part = batch.take(pa.array(found, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(common, pa.int64())], ["a", "b", "common"])

    return both.select("a", "b", "tokens_a", "tokens_b").mapInArrow(compare, "a bigint, b bigint, common bigint")


def jaccard_classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``class_id`` and ``component_id``.

    A-Z are lower-cased, words end at white space, a set holds distinct ``k``-word shingles (all words as one if
    there are fewer). Documents link when 100 * intersection >= ``percent`` * union. ``class_id`` is the
    smallest id with the same set, ``component_id`` the smallest one that links reach. Null and
    empty texts have no set and are linked with nothing, nor are rows without ``doc_id``: both ids are the row's
    own. Rows that share an id are joined through it. ``percent`` must be 34 to 100.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    profiles = cut_lineage(_profiles(docs, k, percent))
    usable = profiles.filter("n > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(usable.groupBy("digest", "n").agg(F.min("doc_id").alias("id")))
    sole = cut_lineage(
        usable.join(classes.select("digest", "n", F.col("id").alias("_id")), ["digest", "n"]).filter("doc_id = _id")
        .dropDuplicates(["digest", "n"]).select(F.col("doc_id").alias("id"), "n", "prefix", "sig"))
    shingles = sole.select(F.explode("prefix").alias("token"), "n", "id").repartition("token").sortWithinPartitions("token", "n", "id")
    wards = cut_lineage(_wards(shingles, percent))
    # rows sharing an id are connected to begin with
    same_id = usable.join(classes.withColumnRenamed("id", "b"), ["digest", "n"]).select(F.col("doc_id").alias("a"), "b").filter("a <> b").distinct()
    # bitmaps of one length meet: a class also visits every longer one that a similar set may have, two more below 50 percent
    visits = F.sequence(_length("n"), _length(F.ceil(F.col("n") * 100 / percent)))
    wards = wards.withColumn("_length", F.explode(visits)).withColumn("ward", F.xxhash64("ward", "_length")).drop("_length")
    # first round: the smallest of each ward, if signatures allow
    smallest = wards.groupBy("ward").agg(F.min("id").alias("a"), F.count("*").alias("_size")).filter("_size > 1")
    wards = cut_lineage(wards.join(smallest, "ward"))
    stars = wards.filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    sigs = sole.select("id", "n", "sig")
    open_stars = _allowed(
        stars.join(sigs.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b")), "b")
        .join(sigs.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a")), "a"), percent)
    first = cut_lineage(_verified(docs, cut_lineage(open_stars), k, percent).select("a", "b"))
    found = components(first)
    # second round: wards with several components; wards of two were settled by the first
    member = wards.filter("_size > 2").drop("a").join(found, "id", "left")
    member = cut_lineage(member.withColumn("component", F.coalesce("component", "id")))
    unsettled = member.groupBy("ward").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low <> _high").select("ward")
    tiles = _tiles(member.join(unsettled, "ward").join(sigs, ["id", "n"]))
    pairs = cut_lineage(_ward_pairs(tiles, percent).distinct())
    second = cut_lineage(_verified(docs, pairs, k, percent).select("a", "b"))
    joined = components(
        found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(second).unionByName(same_id))
    return (
        profiles.join(classes.withColumnRenamed("id", "class_id"), ["digest", "n"], "left")
        .join(joined.select(F.col("id").alias("class_id"), "component"), "class_id", "left")
        .select(
            "doc_id", F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id")).alias("component_id"))
    )


def _length(n):
    """Class of bitmap lengths of a set size, as in ``_bits``."""
    return F.length(F.bin((4 * (F.col(n) if isinstance(n, str) else n) - 1).cast("bigint")))


def _allowed(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs that two leaves of a signature tree would not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.to_pydict()
            keep = []
            for i, (n, m, s, t) in enumerate(zip(columns["n_a"], columns["n_b"], columns["sig_a"], columns["sig_b"])):
                if 100 * min(n, m) < percent * max(n, m):
                    continue
                size = min(len(s), len(t))
                s, t = _folded(s, size), _folded(t, size)
                common, needed = int(np.bitwise_count(s & t).sum()), fewest_common(n, m, percent)
                if int(np.bitwise_count(s).sum()) - common <= n - needed and int(np.bitwise_count(t).sum()) - common <= m - needed:
                    keep.append(i)
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in ("a", "b")], ["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint")


def _tiles(members: DataFrame) -> DataFrame:
    """Members of large wards dealt to blocks, and a tile for every two blocks.

    A ward within ``TILE`` members is one tile. A larger one is cut into blocks by the hash of the id; every
    pair of blocks, and every block by itself, is a tile, so no pair is missed and no task holds a whole ward.
    """
    blocks = F.ceil(F.col("_size") / F.lit(TILE)).cast("int")
    block = F.pmod(F.xxhash64("id"), blocks.cast("long")).cast("int")
    dealt = members.withColumn("_blocks", blocks).withColumn("_block", block)
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    low, high = F.least("_block", "_other"), F.greatest("_block", "_other")
    return (
        dealt.select(
            F.xxhash64("ward", low, high).alias("tile"), F.when(F.col("_block") == low, 0).otherwise(1).alias("side"),
            "n", "id", "component", "sig")
        .repartition("tile").sortWithinPartitions("tile", "side", "n", "id")
    )
