"""Toxicity, mixing, and the pipeline's stages against plain Python."""

import random
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyport.llm import mixing, toxicity
from tests.llm.samples import documents, folded, frame, plain, prose
from tests.llm.test_searches import brute_components, different, later_places, shingles, without

INSULTS = ["blorkhead", "snivelface", "grumbleton"]


def labelled(n=400, seed=4):
    draw = random.Random(seed)
    syllables = ["an", "er", "on", "the", "re", "in", "ti", "ou"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(draw.choices(syllables, k=draw.randrange(1, 5))) for _ in range(draw.randrange(20, 90))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(draw.randrange(1, 4)):
                words[draw.randrange(len(words))] = draw.choice(INSULTS)
        rows.append((i, " ".join(words).capitalize() + ".", "en", f"src{i % 4}", 0, "x", "k", 1, 2, 3))
        labels.append((i, 1, toxic))
    return rows, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_toxicity(spark):
    rows, labels = labelled()
    odd = [(1000, None), (1001, ""), (1002, "only the andthe words"), (1003, "You BLORKHEAD!"), (1004, "b l o r k h e a d"), (1005, "anerti blorxkhead on"), (1006, "x" * 50_000)]
    found = toxicity.toxicity(frame(spark, rows + [(i, t, *rows[0][2:]) for i, t in odd]), spark.createDataFrame(labels + [(5, None, None)], LABELS))
    result = {r.doc_id: (r.score, r.predicted) for r in found.collect()}
    held_out = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(result[i][1] == y for i, y in held_out) >= 0.97 * len(held_out)
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for s, p in result.values())
    assert [result[i][1] for i in (1000, 1001, 1002, 1003, 1004, 1005, 1006)] == [0, 0, 0, 1, 1, 1, 0]


def test_toxicity_uses_no_held_out_label(spark):
    rows, labels = labelled(60)
    used = {r.doc_id for r in toxicity.training_rows(frame(spark, rows), spark.createDataFrame(labels, LABELS), 10).collect()}
    assert 0 < len(used) <= 20 and all(zlib.crc32(str(i).encode()) % 5 for i in used)


def test_toxicity_without_labels(spark):
    for labels in ([], [(1, 1, 0)], [(7, 1, 1)]):
        found = toxicity.toxicity(frame(spark), spark.createDataFrame(labels, LABELS))
        assert found.filter("predicted = 1").count() == 0 and found.count() == len(documents())
    assert toxicity.toxicity(frame(spark).limit(0), spark.createDataFrame([(1, 1, 0)], LABELS)).collect() == []


def test_kernel_is_that_of_the_subsequences():
    def features(word):
        letters = [0, *toxicity._codes(word)[1:-1].tolist(), 1]
        out = defaultdict(float)
        out["whole", word] += toxicity.WHOLE
        for i in range(len(letters)):
            for spread in toxicity.SPREADS:
                if i + spread[-1] < len(letters):
                    out[tuple(letters[i + o] for o in spread)] += toxicity.DECAY ** (spread[-1] + 1 - len(spread))
        return out

    words = [b"moron", b"morxon", "grün".encode(), b"a", b"aaaaaaa"]
    for v in words:
        for w in words:
            a, b = features(v), features(w)
            norm = lambda x: sum(y * y for y in x.values()) ** 0.5
            expected = sum(a[u] * b[u] for u in a if u in b) / norm(a) / norm(b)
            assert abs(toxicity._kernel([v], [w])[0, 0] - expected) < 1e-5


def brute_targets(sizes):
    """The rule as it is told: stop at twice the size, deal the excess by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, stopped, rest = {s: 0.0 for s in names}, set(), 1.5 * sum(sizes.values())
    while rest > 1e-9:
        left = [s for s in names if s not in stopped]
        share = rest / sum(weight[s] for s in left)
        rest = 0.0
        for s in left:
            target[s] += share * weight[s]
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                stopped.add(s)
    return target


@pytest.mark.parametrize("digit", [32, 3])
def test_mixing(spark, monkeypatch, digit):
    monkeypatch.setattr(mixing, "_DIGIT", digit)
    draw = random.Random(8)
    rows = documents() + [(200 + i, prose(i, draw.randrange(0, 60)), "en", draw.choice(["a", "b", "é", "Z", "zz", None]), 1, "", "", 1, 1, 1) for i in range(300)]
    mixed = mixing.mix(frame(spark, rows)).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, _, source, *_ in rows:
        sizes[source] += len(plain(text))
    target = brute_targets(sizes)
    assert sorted((r.doc_id, r.source or "", r.size) for r in mixed) == sorted((r[0], r[3] or "", len(plain(r[1]))) for r in rows)
    for r in mixed:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    cut = [r for r in mixed if r.copies != int(r.copies)]
    assert len(cut) == len({r.source for r in cut})
    again = mixing.mix(frame(spark, rows).repartition(2)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, mixed))


def test_mixing_keeps_expectations(spark):
    rows = [(i, "w " * (i % 7 + 1), "en", "s", 1, "", "", 1, 1, 1) for i in range(40)] + [(99, "w " * 400, "en", "t", 1, "", "", 1, 1, 1)]
    sums = np.zeros(40)
    for seed in range(25):
        for r in mixing.mix(frame(spark, rows), seed=100 * seed).collect():
            if r.doc_id < 40:
                sums[r.doc_id] += r.copies / 25
                share = r.target / r.source_size
    assert abs(sums.mean() - share) < 0.1 and sums.std() < 0.25


def test_mixing_nothing(spark):
    assert mixing.mix(frame(spark).limit(0)).collect() == []
    empty = [(1, None, "en", None, 0, "", "", 1, 1, 1), (2, "  ", "en", "s", 0, "", "", 1, 1, 1)]
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in mixing.mix(frame(spark, empty)).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_no_plan_of_mixing_holds_the_settling_of_a_level(spark):
    mixed = mixing.mix(frame(spark, [(i, "a b c " * (i % 7), "en", "s", 1, "", "", 1, 1, 1) for i in range(90)]))
    assert "collect_list" not in mixed._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = labelled(200)
    rows = rows + [(1000 + r[0], *r[1:]) for r in documents()]
    words = folded(rows[205][1])
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, key string, words int, n_lines int, _key int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(words[10:40])), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, labels, words[10:40]


def test_pipeline(spark, corpus):
    folder, rows, _, item = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), [rows]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "mixing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        seen.append([tuple(r) for r in docs.collect()])
        docs = spark.createDataFrame(seen[-1], docs.schema)
    original, gentle, lined, single, clean, mixed = seen
    texts = lambda rows: {r[0]: r[1] for r in rows}
    insulting = {r[0] for r in original if any(w in (r[1] or "").lower() for w in INSULTS)}
    assert {r[0] for r in original} - {r[0] for r in gentle} == insulting and insulting
    # lines
    split = lambda t: t.split("\n") if t is not None else []
    later = later_places(texts(gentle), split, 3)
    expected = {}
    for doc, text in texts(gentle).items():
        kept = without(split(text), [s for s in later[doc] if "".join(split(text)[s:s + 3]).strip(" ")], 3)
        if kept or not split(text):
            expected[doc] = None if text is None else "\n".join(kept)
    assert texts(lined) == expected and all(r[4] == len(r[1]) for r in lined if r[1] is not None and r[1] != texts(gentle)[r[0]])
    # groups
    roots = brute_components({d: shingles(t, 5) for d, t in texts(lined).items()}, 80)
    assert sorted(r[0] for r in single) == sorted(d for d in roots if roots[d] == d) and len(single) < len(lined)
    # benchmark
    windows = {tuple(item[i:i + 10]) for i in range(len(item) - 9)}
    hit = {d for d, t in texts(single).items() if any(tuple(folded(t)[i:i + 10]) in windows for i in range(len(folded(t))))}
    assert {r[0] for r in clean} == {r[0] for r in single} - hit and hit
    # mix
    sizes = defaultdict(int)
    for r in clean:
        sizes[r[3]] += len(plain(r[1]))
    target, taken = brute_targets(sizes), defaultdict(int)
    for r in mixed:
        taken[r[1]] += r[6]
    assert len(mixed) == len(clean) and all(abs(taken[s] - target[s]) <= 1 for s in sizes)


def test_pipeline_of_nothing(spark, corpus):
    folder, *_ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.collect() == []


def test_toxicity_slices_batches_by_rows_and_bytes():
    import pyarrow as pa

    texts = ["x" * 100] * 30 + [None, "y" * 5000, ""] + ["z"] * 2000
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(toxicity.slices(batch, 0, rows=500, limit=1000))
    assert sum(p.num_rows for p in parts) == len(texts)
    assert all(p.num_rows <= 500 for p in parts)
    assert all(sum(len(t or "") for t in p.column(0).to_pylist()) <= 1000 or p.num_rows == 1 for p in parts)
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts


def test_toxicity_passes_columns_with_odd_names(spark):
    rows, labels = labelled(120)
    docs = frame(spark, rows).withColumn("a b", F.struct(F.lit(1).alias("c d")))
    found = toxicity.toxicity(docs, spark.createDataFrame(labels, LABELS))
    assert found.count() == len(rows) and "a b" in found.columns
