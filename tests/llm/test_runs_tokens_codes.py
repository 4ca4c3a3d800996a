"""Periodic runs, token files and vector codes against plain Python on small tables with the hard cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyport.llm import periodic_runs, token_files, vector_codes
from tallyport.llm.queries import QUERIES, vocabulary
from tests.llm import samples


def brute_runs(words):
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    seq = np.array([ids[w] for w in words], np.int64)
    n, best = len(seq), {}
    for q in range(1, n // 3 + 1):
        edges = np.diff(np.concatenate(([0], (seq[:-q] == seq[q:]).astype(np.int8), [0])))
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
            if b - a + q >= max(24, 3 * q) and best.get((a, b + q), q + 1) > q:
                best[(int(a), int(b + q))] = q
    return sorted(((a, e - a, q) for (a, e), q in best.items()), key=lambda r: (r[0], r[2]))


def planted_rows():
    draw = random.Random(5)
    unit = lambda p: [f"u{draw.randrange(50)}" for _ in range(p)]
    texts = []
    for period in (1, 2, 7, 33, 40, 64, 100, 257):
        body = unit(period)
        texts.append(" ".join(samples.plain(samples.prose(period, 60)) + body * (3 + period % 4) + body[:period // 2]
                              + samples.plain(samples.prose(period + 1, 40))))
    texts += ["go " * 23, "go " * 24, "a b " * 12, "a b " * 11 + "a", " ".join(["x"] * 20000)]
    return [(1000 + i, t, "en", "s", len(t), "s", "k", 1, 2, 3) for i, t in enumerate(texts)]


def test_runs_equal_plain_lag_scans_on_random_texts():
    draw = random.Random(3)
    for _ in range(300):
        n = draw.choice([0, 5, 30, 120, 700, 2000])
        seq = [draw.randrange(draw.choice([1, 2, 4, 60])) for _ in range(n)]
        for _ in range(draw.randrange(4)):
            p, a = draw.choice([1, 3, 8, 33, 50, 65, 120, 300]), draw.randrange(max(n, 1))
            for i in range(a + p, min(n, a + draw.randrange(p, 5 * p + 30))):
                seq[i] = seq[i - p]
        ids = np.array(seq, np.int64)
        direct = [(a, e, q) for _, a, e, q in periodic_runs.direct_runs(ids, np.zeros(n, np.int64))]
        assert periodic_runs.doc_runs(ids, direct) == brute_runs(seq)


def test_one_repeated_word_is_fast_and_one_run():
    ids = np.zeros(30000, np.int64)
    direct = [(a, e, q) for _, a, e, q in periodic_runs.direct_runs(ids, np.zeros(len(ids), np.int64))]
    assert periodic_runs.doc_runs(ids, direct) == [(0, 30000, 1)]


def test_runs_in_spark_with_nulls_repeats_and_clashing_columns(spark):
    rows = samples.documents() + planted_rows()
    df = samples.frame(spark, rows).withColumn("words", F.split("text", r"[\x20\x09-\x0D]+"))
    df = df.withColumn("runs", df["score"]).withColumn("collapsed", df["key"])
    found = periodic_runs.periodic_runs(df.select("doc_id", "words", "runs", "collapsed", "lang")).collect()
    assert len(found) == len(rows)
    for row in found:
        words = list(row["words"] or [])
        runs = brute_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == runs
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert row["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in drop)
        assert row["lang"] == "en"
    assert any(row["runs"] for row in found)


def test_empty_table_gives_no_runs(spark):
    empty = spark.createDataFrame([], "doc_id long, words array<string>")
    assert periodic_runs.periodic_runs(empty).collect() == []


def test_token_files_round_trip_and_seek():
    draw = np.random.default_rng(1)
    docs = [draw.integers(0, 50000, draw.integers(1, 3000)).astype(np.uint32) for _ in range(40)]
    keys = list(range(40))
    keys[7] = None
    data = token_files.pack(keys, docs, frame_bytes=4096)
    frames, listed = token_files.layout(data)
    assert len(frames) > 5 and [d for d, *_ in listed] == keys
    assert all((a == b).all() for (_, a), b in zip(token_files.read_documents(data), docs))
    (one,) = token_files.read_documents(data, {33})
    assert (one[1] == docs[33]).all()
    broken = bytearray(data)
    broken[frames[2][0] + 20] ^= 0xFF
    with pytest.raises(Exception):
        token_files.read_documents(bytes(broken))


def test_token_query_equals_direct_encoding(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = samples.documents() + [(None, "no id", "en", "s", 5, "s", "k", 1, 2, 3), (None, None, "en", "s", 0, "s", "k", 1, 2, 3)]
    df = samples.frame(spark, rows)
    folder = str(tmp_path / "tokens")
    token_files.write_token_files(df, folder, vocabulary()).collect()
    got = token_files.read_token_files(spark, folder).orderBy("start").collect()
    tok = Tokenizer.from_file(vocabulary())
    import xxhash

    def text_hash(t):  # Spark's xxhash64 (seed 42, signed); null texts first
        if t is None:
            return (0, 0)
        value = xxhash.xxh64_intdigest(t.encode(), 42)
        return (1, value - (1 << 64) * (value >= 1 << 63))

    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, text_hash(r[1])))
    start = 0
    assert len(got) == len(ordered)
    for row, want in zip(got, ordered):
        ids = np.array(tok.encode(want[1] or "", add_special_tokens=False).ids + [0], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (want[0], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pieces_give_the_ids_of_whole_texts_and_are_encoded_once(monkeypatch, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary())
    draw = random.Random(3)
    parts = ["a", "don't", "It's", "x1", "é", "ß9", "漢字", "…", "—", "😀", " ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "\u180e", "\u200b", "\u2028",
             "\u0085", "\x1c", "\ufeff", "'", "'s", " 's", "<|endoftext|>", " <|endoftext|> ", "<|endof", "!?", "\x00", "e\u0301", "z" * 80]
    texts = ["", " ", None] + ["".join(draw.choice(parts) + draw.choice(["", " ", " "]) for _ in range(draw.randint(1, 30))) for _ in range(3000)]
    monkeypatch.setattr(token_files, "MEMO_PIECES", 500)  # forgets on the way
    for start in range(0, len(texts), 100):
        for text, ids in zip(texts[start:start + 100], token_files.encode(texts[start:start + 100], vocabulary(), 0)):
            assert ids.tolist() == tok.encode(text or "", add_special_tokens=False).ids + [0]

    seen = []

    class Counting:
        def encode_batch(self, some, **rest):
            seen.extend(some)
            return tok.encode_batch(some, **rest)

        def to_str(self):
            return tok.to_str()

    monkeypatch.setitem(token_files._tokenizers, "counted", Counting())
    token_files.encode(["one two two", "two one two two"], "counted", 0)
    token_files.encode(["one two three"], "counted", 0)
    assert sorted(seen) == [" one", " three", " two", "one", "two"]
    # a tokenizer that may look past a blank gets whole texts
    spec = str(tmp_path / "prefixed.json")
    open(spec, "w").write(tok.to_str().replace('"add_prefix_space":false', '"add_prefix_space":true'))
    assert not token_files.cuttable(spec) and token_files.cuttable(vocabulary())


@pytest.mark.parametrize("openings", [True, False])
def test_many_pieces_go_through_the_tokenizer_together(monkeypatch, openings):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary())
    seen = []

    class Counting:
        def encode_batch(self, some, **rest):
            seen.extend(some)
            return tok.encode_batch(some, **rest)

        def to_str(self):
            return tok.to_str()

        def get_vocab(self, **rest):
            return tok.get_vocab(**rest) if openings else {"a": tok.get_vocab_size() - 1}

    monkeypatch.setitem(token_files._tokenizers, f"many {openings}", Counting())
    monkeypatch.setattr(token_files, "MEMO_PIECES", 2000)
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdéß漢😀.,'<|") for _ in range(draw.randint(1, 9)))
    words = [word() for _ in range(3000)] + ["<|endoftext|>", "\u0120a", "\u010a", "x\0y", "", "\t", "\u00a0", "z" * 90]
    texts = ["".join(draw.choice(words) + draw.choice([" ", " ", " ", "\n"]) for _ in range(200)) for _ in range(40)]
    texts += ["\n".join(words[:3000]), " ".join(words[:3000]), "x\0y", "x", " y", "x\t y", "x\t", "\n", " ", ""]
    for start in range(0, len(texts), 10):
        for text, ids in zip(texts[start:start + 10], token_files.encode(texts[start:start + 10], f"many {openings}", 0)):
            assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids + [0]
    if openings:
        different = {p for t in texts for p in re.findall(r"\s?\S+", t)}
        assert len(seen) < len(different) / 3


def test_token_files_of_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    folder = str(tmp_path / "none")
    token_files.write_token_files(empty, folder, vocabulary()).collect()
    assert token_files.read_token_files(spark, folder).collect() == []


def test_dual_tree_assignment_equals_brute_force():
    draw = np.random.default_rng(2)
    for trial in range(150):
        n, m, k = int(draw.integers(0, 400)), int(draw.integers(0, 6)), int(draw.integers(1, 65))
        points = draw.integers(-4, 4, (n, m)) if trial % 2 else draw.integers(-300, 300, (n, m))
        entries = points[:k].copy() if n >= k and trial % 3 else draw.integers(-300, 300, (k, m))
        chosen, counts, sums = vector_codes.assign(points, entries)
        if n:
            d = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
            assert (chosen == d.argmin(axis=1)).all()
            assert (counts == np.bincount(chosen, minlength=k)).all()
            assert (sums == np.array([points[chosen == e].sum(axis=0) for e in range(k)]).reshape(k, m)).all()


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, l, [int(np.floor(256 * float(x))) for x in v]) for i, v, l in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out, books = {}, {}
    for d in sorted({len(v) for _, _, v in kept}):
        group = [r for r in kept if len(r[2]) == d]
        cols = [[c for c in range(d) if c * parts // d == j] for j in range(parts)]
        first = sorted(group, key=lambda r: (r[0], r[2]))[:entries]
        book = [[[r[2][c] for c in cols[j]] for r in first] for j in range(parts)]

        def nearest(j, v):
            dist = [sum((v[c] - e[t]) ** 2 for t, c in enumerate(cols[j])) for e in book[j]]
            return dist.index(min(dist)), min(dist)

        for _ in range(rounds):
            for j in range(parts):
                chosen = [nearest(j, v)[0] for _, _, v in group]
                for e in range(len(book[j])):
                    mine = [v for (_, _, v), c in zip(group, chosen) if c == e]
                    if mine:
                        book[j][e] = [sum(v[c] for v in mine) // len(mine) for c in cols[j]]
        books[d] = book
        for i, l, v in group:
            picks = [nearest(j, v) for j in range(parts)]
            out.setdefault(i, []).append(("".join(f"{e:02x}" for e, _ in picks), sum(x for _, x in picks), l, d))
    return out, books


def test_vector_codes_equal_plain_lloyd_with_bad_rows(spark):
    draw = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in draw.normal(size=32)], int(i % 3) if i % 5 else None) for i in range(150)]
    rows += [(500, [float(x) for x in draw.normal(size=20)], 1), (501, None, 1), (502, [1.0, None] * 16, 1),
             (503, [float("nan")] * 32, 2), (504, [float("inf")] + [0.0] * 31, 2), (7, rows[7][1], rows[7][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    want, books = brute_codes(as_float)
    coded, got_books = vector_codes.train_codes(df)
    got = sorted((r["vec_id"], r["code"], r["error"]) for r in coded.collect())
    assert got == sorted((i, c, e) for i, found in want.items() for c, e, _, _ in found)
    for d, book in books.items():
        assert [b.tolist() for b in got_books[d]] == book
        assert vector_codes.books_digest(got_books[d]) == hashlib.sha256(
            ",".join(str(x) for part in book for entry in part for x in entry).encode()).hexdigest()


def test_vector_codes_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    coded, books = vector_codes.train_codes(empty)
    assert coded.collect() == [] and books == {}


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_token_files", "op13_vector_codes"])
def test_queries_run_on_the_smallest_tables(spark, name):
    result = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert result.count() > 0
