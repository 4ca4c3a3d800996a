"""The registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallyport.llm import (
    decontaminate, hamming_search, jaccard_join, licenses, line_dedup, mixing, periodic_runs, phrase_dedup, secrets,
    suffix_dedup, token_files, toxicity, vector_codes,
)
from tallyport.llm.columns import small
from tallyport.session import cut_lineage, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op5_secrets(spark, sf_dir):
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.span_list(F.col("base")), 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans"),
    )


@query
def op8_decontamination(spark, sf_dir):
    marked = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


ORACLE["op8_decontamination"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
), doc_window AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM words, (SELECT DISTINCT n FROM item_window), unnest(range(1, len(w) + 1)) AS t(i) WHERE i + n - 1 <= len(w)
), hit AS (
  SELECT doc_id, i, d.n, item_id FROM doc_window d JOIN item_window USING (n, s)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op10_line_dedup(spark, sf_dir):
    kept = line_dedup.dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op10_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, i, l[i] AS line, len(l) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
         unnest(range(1, len(l) + 1)) AS t(i)
), windows AS (
  SELECT doc_id, i, n, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS s
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k
  FROM windows WHERE i + 2 <= n AND trim(replace(s, chr(10), '')) <> ''
), gone AS (
  SELECT DISTINCT doc_id, p AS i FROM ranked, unnest(range(i, i + 3)) AS t(p) WHERE k > 1
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS kept, count(*) AS n
  FROM lines ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0) AS n_lines,
       CAST(coalesce(len(string_split(text, chr(10))), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


@query
def op1_licenses(spark, sf_dir):
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("places", lambda p: p["base"])
    labels = lambda places: F.transform(places, lambda p: p["label"])
    listed = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    starts = F.transform(base, lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        listed(labels(base)).alias("base_labels"),
        listed(F.concat(labels(F.col("places")), F.flatten(F.transform("expressions", lambda e: e["labels"])))).alias("labels"),
        "score", F.exists("expressions", lambda e: e["permissive"]).alias("permissive"),
    )


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op2_jaccard_join(spark, sf_dir):
    found = jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"), k=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


ORACLE["op2_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 4) - 1], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT a AS id, b AS other FROM link UNION SELECT id, b FROM reach JOIN link ON other = a
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
FROM words w LEFT JOIN size ON size.doc_id = w.doc_id
     LEFT JOIN (SELECT id, min(other) AS m FROM reach GROUP BY id) r ON r.id = w.doc_id
"""


@query
def op7_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["first"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", "n_words", "n_repeated", F.array_join(spans, ",").alias("spans"),
                        F.array_join(F.transform("partners", lambda p: p.cast("string")), ",").alias("partners"))


_PLAIN_WINDOWS = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {n} - 1], ' ') AS s FROM words, unnest(range(1, len(w) - {n} + 2)) AS t(i)
), """
ORACLE["op7_suffix_dedup"] = _PLAIN_WINDOWS.format(n=50) + r"""again AS (
  SELECT doc_id, i, lag(doc_id) OVER g AS low, lead(doc_id) OVER g AS high
  FROM windows WINDOW g AS (PARTITION BY s ORDER BY doc_id, i) QUALIFY count(*) OVER (PARTITION BY s) > 1
), hit AS (
  SELECT DISTINCT doc_id, p FROM again, unnest(range(i, i + 50)) AS t(p)
), span AS (
  SELECT doc_id, min(p) AS a, max(p) + 1 AS b
  FROM (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS island FROM hit) GROUP BY doc_id, island
), spans AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n, string_agg((a - 1) || ':' || (b - 1), ',' ORDER BY a) AS spans FROM span GROUP BY doc_id
), partners AS (
  SELECT doc_id, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS partners
  FROM (SELECT doc_id, low AS p FROM again UNION SELECT doc_id, high FROM again) WHERE p <> doc_id GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n, 0) AS n_repeated, coalesce(spans, '') AS spans,
       coalesce(partners, '') AS partners
FROM words LEFT JOIN spans USING (doc_id) LEFT JOIN partners USING (doc_id)
"""


@query
def op9_phrase_dedup(spark, sf_dir):
    found = phrase_dedup.dedupe_phrases(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op9_phrase_dedup"] = _PLAIN_WINDOWS.format(n=20) + r"""ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM windows
), gone AS (
  SELECT DISTINCT doc_id, p FROM ranked, unnest(range(i, i + 20)) AS t(p) WHERE k > 1
), kept AS (
  SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS kept, count(*) AS n
  FROM words, unnest(range(1, len(w) + 1)) AS t(i)
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = words.doc_id AND p = i) GROUP BY doc_id
)
SELECT w.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(len(w), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""


@query
def op3_nearest(spark, sf_dir):
    vectors = hamming_search.usable_vectors(table(spark, sf_dir, "embeddings"))
    return hamming_search.nearest(vectors, F.col("vec_id") % 100 == 0)


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


# Fixed values of the planted periods: one document in ten, from a place and with a period drawn from crc32 of its id.
_PLANTED = """
  CASE WHEN h % 10 = 0 AND size(w) > 0 THEN
    transform(w, (x, i) -> IF(i >= g % size(w),
                              w[g % size(w) + (i - g % size(w)) % (1 + (size(w) - g % size(w)) div (3 + g % 8))], x))
  ELSE w END
"""
_BEST = """get(array_sort(runs, (x, y) -> CASE
  WHEN x.length * y.period <> y.length * x.period THEN IF(x.length * y.period > y.length * x.period, -1, 1)
  WHEN x.start <> y.start THEN IF(x.start < y.start, -1, 1)
  WHEN x.period <> y.period THEN IF(x.period < y.period, -1, 1) ELSE 0 END), 0)"""


@query
def op11_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.coalesce(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""), F.array().cast("array<string>"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = (docs.withColumn("w", words).withColumn("h", h).withColumn("g", F.expr("h div 10"))
               .select("doc_id", F.expr(_PLANTED).alias("words")))
    found = periodic_runs.periodic_runs(planted).withColumn("best", F.expr(_BEST))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer's file; a parameter of the query, never copied here."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op12_token_files(spark, sf_dir):
    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary()).collect()
    return token_files.read_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op13_vector_codes(spark, sf_dir):
    coded, books = vector_codes.train_codes(table(spark, sf_dir, "embeddings"))
    coded = cut_lineage(coded.select("vec_id", "label", "d", "code", "error"))
    digests = spark.createDataFrame([(d, vector_codes.books_digest(b)) for d, b in books.items()], "d int, codebooks_sha256 string")
    by_label = cut_lineage(coded.groupBy(F.col("label").alias("same_label")).agg(F.sum("error").alias("label_error")))
    joined = coded.join(small(by_label), coded["label"].eqNullSafe(by_label["same_label"])).join(F.broadcast(digests), "d")
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _lloyd_sql(rounds: int = vector_codes.ROUNDS, entries: int = vector_codes.ENTRIES, parts: int = vector_codes.PARTS) -> str:
    steps = []
    for r in range(1, rounds + 2):
        steps.append(f"""a{r} AS (
  SELECT rid, p.part, c.entry, sum((p.x - c.c) * (p.x - c.c)) AS dist
  FROM comp p JOIN c{r - 1} c ON c.d = p.d AND c.part = p.part AND c.pos = p.pos GROUP BY ALL
), pick{r} AS (
  SELECT rid, part, entry, dist FROM a{r} QUALIFY row_number() OVER (PARTITION BY rid, part ORDER BY dist, entry) = 1
)""")
        if r <= rounds:
            steps.append(f"""c{r} AS (
  SELECT o.d, o.part, o.entry, o.pos, coalesce(n.c, o.c) AS c FROM c{r - 1} o LEFT JOIN (
    SELECT p.d, p.part, k.entry, p.pos, CAST(floor(sum(p.x) / count(*)) AS BIGINT) AS c
    FROM comp p JOIN pick{r} k ON k.rid = p.rid AND k.part = p.part GROUP BY ALL
  ) n USING (d, part, entry, pos)
)""")
    last = rounds + 1
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), comp AS (
  SELECT rid, len(ints) AS d, ((i - 1) * {parts}) // len(ints) AS part, i - 1 AS pos, ints[i] AS x
  FROM kept, unnest(range(1, len(ints) + 1)) AS t(i)
), first AS (
  SELECT rid, len(ints) AS d, row_number() OVER (PARTITION BY len(ints) ORDER BY vec_id, ints) - 1 AS entry FROM kept
  QUALIFY entry < {entries}
), c0 AS (
  SELECT c.d, c.part, f.entry, c.pos, c.x AS c FROM first f JOIN comp c USING (rid)
), {", ".join(steps)}, coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error
  FROM pick{last} GROUP BY rid
), books AS (
  SELECT d, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c{rounds} GROUP BY d
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid) JOIN books ON books.d = len(kept.ints)
"""


ORACLE["op13_vector_codes"] = _lloyd_sql()
