"""Operators against plain Python, on small tables with odd rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyport.llm import decontaminate, hamming_search, jaccard_join, licenses, line_dedup, phrase_dedup, recurrence, secrets, suffix_dedup
from tallyport.llm.components import components
from tests.llm.samples import different, documents, folded, frame, plain, prose


def grouped(rows):
    out = defaultdict(set)
    for row in rows:
        out[row[0]].add(tuple(row[1:]))
    assert all(len(v) == 1 for v in out.values())  # rows that repeat get the same result
    return {k: next(iter(v)) for k, v in out.items()}


def later_places(texts, tokens, width):
    """Starts of windows that also start earlier, by document."""
    first, later = {}, defaultdict(list)
    for doc in sorted(texts):
        items = tokens(texts[doc])
        for i in range(len(items) - width + 1):
            if first.setdefault(tuple(items[i:i + width]), (doc, i)) < (doc, i):
                later[doc].append(i)
    return later


def without(items, starts, width):
    gone = {p for s in starts for p in range(s, s + width)}
    return [x for i, x in enumerate(items) if i not in gone]


def test_phrases(spark):
    found = phrase_dedup.dedupe_phrases(frame(spark), 20).drop("kept")
    texts = different(documents())
    later = later_places(texts, plain, 20)
    for doc, (n, removed, digest) in grouped(found.collect()).items():
        kept = without(plain(texts[doc]), later[doc], 20)
        assert (n, removed) == (len(plain(texts[doc])), len(plain(texts[doc])) - len(kept))
        assert digest == hashlib.sha256(" ".join(kept).encode()).hexdigest()
    assert found.count() == len(documents())


def test_phrases_with_a_shard_for_each_part(spark, monkeypatch):
    monkeypatch.setattr(phrase_dedup, "SHARD", 2)
    test_phrases(spark)


@pytest.mark.parametrize("shard", [3, 4000])
def test_phrases_bring_words_of_first_occurrences_only_and_shuffle_texts_once(spark, monkeypatch, shard):
    monkeypatch.setattr(phrase_dedup, "SHARD", shard)
    monkeypatch.setattr(phrase_dedup, "BROADCAST_BYTES", 0)
    written = []
    cut = phrase_dedup.cut_lineage
    monkeypatch.setattr(phrase_dedup, "cut_lineage", lambda df: (written.append(cut(df)), written[-1])[1])
    passage, common = prose(11, 200), " ".join(["go", "on"] * 12)
    texts = [prose(100 + i, 15 + i) + " " + passage + " " + prose(200 + i, 30) for i in range(12)]
    texts += [prose(300 + i, 10, 3) + f" own{i} " + common + " " + prose(400 + i, 60, 2) for i in range(12)]
    texts += [passage] * 30 + [prose(500, 300, 2), prose(500, 300, 2) + " more", None, ""]
    rows = [(3 * i % 71, t, "en", "src", 1, "", "", 1, 1, 1) for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[1], "en", "src", 1, "", "", 1, 1, 1)]
    found = phrase_dedup.dedupe_phrases(frame(spark, rows)).drop("kept")
    texts = {-1 if d is None else d: t for d, t in different(rows).items()}
    later = later_places(texts, plain, 20)
    for doc, (n, removed, digest) in grouped((-1 if r[0] is None else r[0], *r[1:]) for r in found.collect()).items():
        kept = without(plain(texts[doc]), later[doc], 20)
        assert (n, removed) == (len(plain(texts[doc])), len(plain(texts[doc])) - len(kept))
        assert digest == hashlib.sha256(" ".join(kept).encode()).hexdigest()
    # stretches are written without their words; those of equal words are looked at once
    assert not any("words" in df.columns for df in written)
    assert written[0].filter("anchor IS NOT NULL").count() < written[0].filter("anchor IS NULL").count()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def test_stretches_of_a_common_word_pair_do_not_meet_in_one_place(spark):
    rows = [(i, prose(600 + i, 30) + " " + " ".join(["go", "on"] * 40), "en", "src", 1, "", "", 1, 1, 1) for i in range(200)]
    found = recurrence.stretches(recurrence.keyed(frame(spark, rows + rows[:50]).coalesce(2)), 20, 6)
    groups = [r["count"] for r in found.groupBy("anchor").count().collect()]
    assert sum(groups) > 5000 and max(groups) < sum(groups) / 10
    kept = {r.doc_id: r.n_words - r.n_removed for r in phrase_dedup.dedupe_phrases(frame(spark, rows)).collect()}
    later = later_places(different(rows), plain, 20)
    assert kept == {r[0]: len(without(plain(r[1]), later[r[0]], 20)) for r in rows}


def test_lines(spark):
    found = line_dedup.dedupe_lines(frame(spark))
    assert found.columns[-2:] == ["n_lines", "n_removed"] and "_key" not in found.columns
    texts = different(documents())
    split = lambda t: t.split("\n") if t is not None else []
    later = later_places(texts, split, 3)
    for doc, (text, n, removed) in grouped(found.select("doc_id", "text", "n_lines", "n_removed").collect()).items():
        lines = split(texts[doc])
        starts = [s for s in later[doc] if "".join(lines[s:s + 3]).strip(" ")]
        kept = without(lines, starts, 3)
        assert (n, removed, text) == (len(lines), len(lines) - len(kept), None if texts[doc] is None else "\n".join(kept))


def test_repeated_passages(spark):
    found = suffix_dedup.repeated_passages(frame(spark), 50)
    texts = different(documents())
    places = defaultdict(list)
    for doc in texts:
        items = plain(texts[doc])
        for i in range(len(items) - 49):
            places[tuple(items[i:i + 50])].append((doc, i))
    covered, partners = defaultdict(set), defaultdict(set)
    for spots in places.values():
        if len(spots) > 1:
            spots.sort()
            for place, (doc, i) in enumerate(spots):
                covered[doc].update(range(i, i + 50))
                partners[doc].update({d for d, _ in spots[max(0, place - 1):place + 2]} - {doc})
    rows = grouped((r.doc_id, r.n_words, r.n_repeated, tuple((s.first, s.end) for s in r.spans), tuple(r.partners)) for r in found.collect())
    for doc, (n, repeated, spans, others) in rows.items():
        assert (n, repeated, others) == (len(plain(texts[doc])), len(covered[doc]), tuple(sorted(partners[doc])))
        assert {p for a, b in spans for p in range(a, b)} == covered[doc]


def shingles(text, k):
    words = [w for w in plain("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(sets, percent):
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in sets}


@pytest.mark.parametrize("k, percent, tile", [(4, 85, 1000), (5, 80, 3), (2, 50, 4)])
def test_jaccard(spark, monkeypatch, k, percent, tile):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    rows = documents()
    words = prose(30, 120).split(" ")
    for i in range(40):  # a chain of near copies: each a few words from the one before
        words = words[:3 * i] + [f"new{i}"] + words[3 * i + 1:]
        rows.append((100 + i, " ".join(words), "en", "src", 1, "", "", 1, 1, 1))
    sets = {d: shingles(t, k) for d, t in different(rows).items()}
    expected = brute_components(sets, percent)
    found = grouped(jaccard_join.jaccard_classes(frame(spark, rows), k, percent).select("doc_id", "n_shingles", "component_id").collect())
    assert found == {d: (len(sets[d]), expected[d]) for d in sets}


def test_jaccard_below_half(spark):
    words, rows = [f"w{i}" for i in range(1000)], []
    for i, (n, m) in enumerate([(60, 100), (62, 180), (30, 80), (100, 140), (60, 177)]):  # the smaller set is part of the larger
        mine = [f"{w}of{i}" for w in words]
        rows += [(10 * i + j, " ".join(mine[:size]), "en", "src", 1, "", "", 1, 1, 1) for j, size in enumerate((n, m))]
    sets = {d: shingles(t, 1) for d, t in different(rows).items()}
    found = jaccard_join.jaccard_classes(frame(spark, rows), 1, 34).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(sets, 34)


def test_traversal_prunes_nothing_similar():
    import numpy as np

    draw = np.random.default_rng(3)
    base = [np.unique(draw.integers(0, 2**63, draw.integers(5, 300)).astype(np.uint64)) for _ in range(30)]
    sets = base + [np.unique(np.concatenate([b[: max(1, int(len(b) * 0.95))], draw.integers(0, 2**63, 2).astype(np.uint64)])) for b in base]
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    sigs = [jaccard_join.signature(s).tobytes() for s in sets]
    tree = jaccard_join._tree_of(n, np.arange(len(sets)), sigs, min(map(len, sigs)))
    found = set(zip(*(x.tolist() for x in jaccard_join.traverse(tree, tree, 80, True))))
    close = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert close and close <= found and len(found) < len(sets) * (len(sets) - 1) / 4


def test_components(spark, rows):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (3, 7), (7, 20), (5, 5), (20, 19)], "a bigint, b bigint")
    assert rows(components(links)) == sorted([(1, 1), (2, 1), (3, 1), (7, 1), (20, 1), (19, 1), (8, 8), (9, 8)], key=repr)
    assert components(links.limit(0)).count() == 0


def test_decontamination(spark):
    rows = documents()
    words = folded(rows[5][1])
    items = [(1, " ".join(words[10:30])), (2, " ".join(words[40:48]).upper()), (30, " ".join(words[60:75]) + " not there at all"), (4, None),
             (5, ""), (6, "..."), (7, "one"), (8, "nowhere to be found in any of these texts at all"), (7, "one"), (9, "go go go go go go go go go go go go")]
    found = decontaminate.decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    texts = different(rows)
    windows = defaultdict(set)
    for item, text in items:
        w = folded(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add(str(item))
    result = grouped((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect())
    for doc, text in texts.items():
        w, hit, ids = folded(text), set(), set()
        for i in range(len(w)):
            for n in range(1, 11):
                if tuple(w[i:i + n]) in windows and i + n <= len(w):
                    hit.update(range(i, i + n))
                    ids |= windows[tuple(w[i:i + n])]
        assert result[doc] == (len(w), len(hit), tuple(sorted(ids)), bool(hit))
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.decontaminate(frame(spark, rows), nothing).filter("contaminated").count() == 0


def test_empty_tables(spark):
    docs = frame(spark).limit(0)
    for found in (phrase_dedup.dedupe_phrases(docs), line_dedup.dedupe_lines(docs), suffix_dedup.repeated_passages(docs), jaccard_join.jaccard_classes(docs),
                  licenses.scan_licenses(docs), secrets.find_secrets(docs),
                  decontaminate.decontaminate(docs, spark.createDataFrame([(1, "a b")], "item_id bigint, text string"))):
        assert found.collect() == []


def brute_licenses(text):
    words, places = folded(text), []
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), sorted(places)


def test_licenses(spark):
    texts = ["Under the MIT License, under the mit license.", "Apache License, Version 2.0 and CC-BY-NC cc by nc", "é under the mit licenseé", None, "",
             "// SPDX-License-Identifier: (MIT OR GPL-2.0+) AND BSD-3-Clause\nmore", "Ünder the mit license under\nthe\tmit license", "cc by nc cc by nc", prose(1, 3000)]
    rows = [(i, t, "en", "s", 1, "s", "k", 1, 2, 3) for i, t in enumerate(texts)]
    for r in licenses.scan_licenses(frame(spark, rows)).collect():
        base = sorted((p.start, p.label) for p in r.places if p.base)
        assert (r.n_words, base) == brute_licenses(texts[r.doc_id]) and 0 <= r.score <= 1
        if r.doc_id == 5:
            assert [(e.labels, e.permissive) for e in r.expressions] == [(["bsd", "gpl", "mit"], True)]


@pytest.mark.parametrize("text, postfix, labels, permissive", [
    ("MIT", ["MIT"], ["mit"], True),
    ("mit or apache-2.0 and gpl-3.0", ["mit", "apache-2.0", "gpl-3.0", "and", "or"], ["apache-2", "gpl", "mit"], True),
    ("(MIT or Apache-2.0) and GPL-3.0-only rest", ["MIT", "Apache-2.0", "or", "GPL-3.0-only", "and"], ["apache-2", "gpl", "mit"], False),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR ISC", ["GPL-2.0-only", "Classpath-exception-2.0", "with", "ISC", "or"], ["gpl", "isc"], True),
    ("MIT and", ["MIT"], ["mit"], True),
    ("MIT and what follows", ["MIT"], ["mit"], True),
])
def test_expressions(text, postfix, labels, permissive):
    found = licenses.parse_expression(text)
    assert (found.postfix, found.labels, found.permissive) == (postfix, labels, permissive)


@pytest.mark.parametrize("text", ["", "and MIT", "unknown", "(MIT", "(MIT or", ")MIT", "with MIT"])
def test_no_expression(text):
    assert licenses.parse_expression(text) is None


@pytest.mark.parametrize("text, labels, permissive", [
    ("MIT AND SSPL-1.0", ["mit", "sspl-1.0"], False),
    ("OFL-1.1 AND GPL-3.0-only", ["gpl", "ofl-1.1"], False),
    ("MIT OR (BUSL-1.1 AND Foo)", ["busl-1.1", "foo", "mit"], True),
    ("MIT-0", ["mit-0"], False), ("MS-PL", ["ms-pl"], False), ("curl", ["curl"], False),
    ("MIT AND inhouse", ["inhouse", "mit"], False), ("inhouse AND MIT", ["inhouse", "mit"], False),
    ("CDDL-1.0+.", ["cddl-1.0"], False), ("MIT. See", ["mit"], True), ("MIT-->", ["mit"], True),
    ("DocumentRef-a-1.2:LicenseRef-b AND MIT", ["mit", "other"], False),
])
def test_identifiers_outside_the_table(text, labels, permissive):
    found = licenses.parse_expression(text)
    assert (found.labels, found.permissive) == (labels, permissive)


ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 16]
    return sorted(out)


def entropy(chars):
    return -sum(c / len(chars) * math.log2(c / len(chars)) for c in Counter(chars).values())


def test_secrets(spark):
    random_key = "xK9fQ2mZ7rLp0WvB4tNs"
    texts = [None, "", 'é日password = "abcdefghijkl" AKIAABCDEFGHIJKLMN0 0123456789abcdef0', "secret: token : abcdefghijklmnop token=short", "AKIAAKIA12 AKIA" + "A" * 30,
             "PassWord:hunter2hunter2 api_key='0123456789abcdef' APIKEY=zzzzzzzzzzzz", f"see {random_key} and {random_key}", "a" * 40 + " example" + random_key,
             "123e4567-e89b-12d3-a456-426614174000", "deadbeef" * 2 + "g" + "0" * 15, "token=" + "a" * 11, "TOKEN=" + "a" * 12 + "é" + "f" * 16, "a1" * 30, prose(9, 4000)]
    rows = [(i, t, "en", "s", 1, "s", "k", 1, 2, 3) for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in secrets.find_secrets(frame(spark, rows)).collect()}
    for i, text in enumerate(texts):
        base = [(s.start, s.kind, s.end) for s in found[i].base]
        assert base == brute_secrets(text)
        assert set(base) <= {(s.start, s.kind, s.end) for s in found[i].spans}
        for s in found[i].spans:
            assert text[s.start:s.end] == s.value
            if s.kind == 3:
                assert max(entropy(s.value[j:j + c.window]) for c in secrets.CLASSES for j in range(len(s.value) - c.window + 1)) >= 2.9
    assert [s.value for s in found[6].spans] == [random_key] * 2
    assert not found[8].spans and not [s for i in (7, 12) for s in found[i].spans if s.kind == 3]


@pytest.mark.parametrize("keys, reported", [
    (["qWxZrTyUkLpMnBvCdFgH", "sk_live_9f8q7w6e5r4t3y2u1i0p", "config/9f8q7w6e5r4t3y2u1i0p/prod", "zK9fxxxxQ2mZ7rLp0WvB4t",
      "k7Q2mexampleZ7rLp0WvB4tNs", "9F3A77C1D2E4B865", "9f3A77c1D2e4B8650", "id=9F3A77C1D2E4B865", "xxxx-K9fQ2mZ7rLp0WvB4tNs"], True),
    (["internationalization", "path/to/some/Readme-file", "docs/chapter2/section-14-intro", "users/123e4567-e89b-12d3-a456-426614174000/profile",
      "id=1234567890123456", "1234-5678-9012-3456-7890", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
      "your_xxxxxxxxxxxx_placeholder_key", "_".join(["ab"] * 50000)], False),
])
def test_allow_list_judges_parts(spark, keys, reported):
    rows = [(i, f"see {k} there", "en", "s", 1, "s", "k", 1, 2, 3) for i, k in enumerate(keys)]
    for r in secrets.find_secrets(frame(spark, rows)).collect():
        assert [s.value for s in r.spans if s.kind == 3] == [keys[r.doc_id]] * reported, keys[r.doc_id][:80]


def test_entropy_by_counts_agrees_with_entropy(spark):
    values = ["abcdefghijklmnopqrst", "aabbccddeeffgghhiijj", "a" * 30 + "abcdefghijklmnopqrst", "xyxyxyxyxyxyxyxyxyxyxyxy", "abc"]
    for bits in (1.5, 3.0, 4.2):
        df = spark.createDataFrame([(v,) for v in values], "v string").select("v", secrets._entropy_reached(F.col("v"), 20, bits).alias("hit"))
        for r in df.collect():
            windows = [entropy(r.v[j:j + 20]) for j in range(len(r.v) - 19)]
            assert r.hit == (bool(windows) and max(windows) >= bits - 1e-9)


def test_nearest(spark):
    import numpy as np

    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(700, 12))
    vectors[50:350] = vectors[100]  # one vector in many rows
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(900, None), (1000, []), (1100, [0.0] * 12), (1200, [float("nan")] + [1.0] * 11), (1300, [None] + [1.0] * 11), (1400, [float("inf")] * 12),
           (1500, [1.0, 2.0]), (None, [1.0] * 12), rows[3], rows[100]]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>")
    usable = hamming_search.usable_vectors(df)
    found = defaultdict(list)
    for r in hamming_search.nearest(usable, F.col("vec_id") % 100 == 0).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert sorted(found) == list(range(0, 700, 100))
    right = 0
    for q, got in found.items():
        got.sort()
        distance = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        distance[q] = np.inf
        order = np.lexsort((np.arange(700), distance))[:10]
        assert [r for r, _, _ in got] == list(range(1, 11))
        assert all(abs(distance[v] - s) < 1e-12 for _, v, s in got)
        right += len({v for _, v, _ in got} & set(order.tolist()))
    assert right >= 0.9 * 70
    assert [v for _, v, _ in sorted(found[100])] == list(range(50, 60))
    few = spark.createDataFrame(rows[:4], "vec_id bigint, embedding array<double>")
    assert hamming_search.nearest(hamming_search.usable_vectors(few), F.col("vec_id") == 0).count() == 3
    assert hamming_search.nearest(hamming_search.usable_vectors(few.limit(0)), F.col("vec_id") == 0).collect() == []


def test_probing_finds_every_code_within_the_radius():
    import numpy as np

    draw = np.random.default_rng(1)
    coder = hamming_search.learn(draw.normal(size=(300, 20)))
    codes = coder.codes(draw.normal(size=(500, 20)))
    index = hamming_search.Index(codes, coder)
    for radius in (0, 3, coder.radius, 20):
        for code in codes[:20]:
            assert index.within(code, radius).tolist() == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()


def test_licenses_pass_columns_with_odd_names(spark):
    from pyspark.sql import functions as F

    docs = frame(spark).withColumn("a b", F.struct(F.lit(1).alias("c d")))
    found = licenses.scan_licenses(docs.select("doc_id", "text", "a b"))
    assert found.count() == len(documents()) and "a b" in found.columns
