"""The corpus pipeline: five stages, each a function of (spark, docs, folder of tables).

Every stage but the last takes and returns rows with the columns of ``documents``:

1. toxicity: documents scored 0.5 or more go.
2. line dedup: lines in three-line windows that also start earlier go; what loses all its lines goes.
3. Jaccard join: of documents linked by five-word shingles at 0.8 or more, the smallest id stays.
4. benchmark decontamination: documents with ten consecutive benchmark words go.
5. mixing: how many copies and words of each remaining document the mix takes.

Null and empty texts are clean and stay; so do rows without ``doc_id``. Columns beyond those of ``documents`` are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyport.llm import decontaminate, jaccard_join, line_dedup, mixing, toxicity
from tallyport.llm.columns import small
from tallyport.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    return toxicity.toxicity(docs, _table(spark, sf_dir, "labels")).filter("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedupe_lines(docs.select(*COLUMNS))
    emptied = (F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.filter(~emptied).withColumn("n_chars", n_chars).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    classes = jaccard_join.jaccard_classes(docs, k=5, percent=80)
    others = cut_lineage(classes.filter("doc_id <> component_id").select("doc_id").distinct())
    kept = docs.join(small(others), "doc_id", "left_anti")
    # rows that repeat an id are one group as well
    again = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "lang", "source", "n_chars"))
    return kept.withColumn("_n", again).filter("_n = 1 OR doc_id IS NULL").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    spans = decontaminate.contaminated_spans(docs, _table(spark, sf_dir, "benchmark"))
    hit = cut_lineage(spans.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct())
    return docs.join(
        small(hit), docs["doc_id"].eqNullSafe(F.col("_doc")) & (F.xxhash64(docs["text"]) == F.col("_hash")), "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]
# A learned score, components over hashes and random draws have no SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
