"""Marks benchmark passages in documents by winnowing.

A text's fingerprints are the smallest hash of every few consecutive k-grams. With k-grams of 5 words and the
smallest of each 6, two texts that share any 10 consecutive words share a fingerprint. Documents and items
meet by fingerprint; where they do, the two are laid side by side and the agreement is extended both ways to
runs of equal words, of which those of at least 10 words (or a whole shorter item) count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.llm.columns import folded_words, small
from tallyport.session import cut_lineage

K = 5


def _grams(words: Column, k: int) -> Column:
    """Hash of every ``k`` consecutive words, in order; null if there are fewer."""
    def hashed(bound):
        return F.transform(
            F.sequence(F.lit(0), F.size(bound) - k), lambda i: F.xxhash64(F.lit(k), *[F.get(bound, i + j) for j in range(k)]))

    return F.when(F.size(words) >= k, F.get(F.transform(F.array(words), hashed), 0))


def _winnowed(words: Column, window: int, k: int = K) -> Column:
    """Distinct smallest k-gram hashes of each ``window`` consecutive words; none if there are fewer."""
    span = window - k + 1

    def chosen(grams):
        return F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size(grams) - (span - 1)), lambda i: F.array_min(F.slice(grams, i, span))))

    kept = F.get(F.transform(F.array(_grams(words, k)), chosen), 0)
    return F.when(F.size(words) >= window, kept).otherwise(F.array().cast("array<bigint>"))


def _short(words: Column, lengths: list[int]) -> list[Column]:
    nothing = F.array().cast("array<bigint>")
    return [F.array_distinct(F.coalesce(_grams(words, n), nothing)) for n in lengths]


def benchmark_items(benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Items with words: ``item_id``, ``item_words`` and ``prints``. Shorter items are one print of all their words."""
    items = benchmark.select("item_id", folded_words(F.col("text")).alias("item_words")).filter(F.size("item_words") > 0)
    whole = F.lit(None).cast("array<bigint>")
    for n in range(1, window):
        whole = F.when(F.size("item_words") == n, _grams(F.col("item_words"), n)).otherwise(whole)
    return items.withColumn("prints", F.when(F.size("item_words") < window, whole).otherwise(_winnowed(F.col("item_words"), window)))


def _runs(least: Column, equal: Column) -> Column:
    """First and end (exclusive) of each maximal run of true that is at least ``least`` long."""
    kind = "array<struct<first:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("run"), F.array().cast(kind).alias("out"))

    def step(state, same):
        run = F.when(same, state["run"] + 1).otherwise(0)
        ended = ~same & (state["run"] >= least)
        closed = F.concat(state["out"], F.array(F.struct((state["at"] - state["run"]).alias("first"), state["at"].alias("end"))))
        return F.struct((state["at"] + 1).alias("at"), run.alias("run"), F.when(ended, closed).otherwise(state["out"]).alias("out"))

    return F.aggregate(F.concat(equal, F.array(F.lit(False))), start, step)["out"]


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``doc_id``, ``text_hash``, ``item_id``, ``first``, ``end``: document words that repeat an item's words."""
    items = cut_lineage(benchmark_items(benchmark, window))
    lengths = [r[0] for r in items.select(F.size("item_words").alias("n")).filter(F.col("n") < window).distinct().collect()]
    prints = cut_lineage(items.select(F.explode("prints").alias("print")).distinct())

    def word_prints(words):
        return F.array_distinct(F.concat(_winnowed(words, window), *_short(words, sorted(lengths))))

    # one pass over all documents; of their fingerprints only those of some item go on
    met = (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), folded_words(F.col("text")).alias("words"))
        .select("doc_id", "text_hash", F.explode(word_prints(F.col("words"))).alias("print"))
        .join(small(prints), "print").select("doc_id", "text_hash").distinct()
    )
    met = cut_lineage(met).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"))
    marked = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    marked = marked.join(small(met), marked["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left_semi")
    # rows that repeat entirely are one document here
    marked = marked.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", folded_words(F.col("text")).alias("words"))

    # where the prints stand in both, and the word to which the item's first word would fall
    def places(words):
        grams = [(k, F.coalesce(_grams(words, k), F.array().cast("array<bigint>"))) for k in [K, *sorted(set(lengths) - {K})]]
        return F.concat(*[F.transform(g, lambda h, i: F.struct(h.alias("print"), i.alias("at"))) for _, g in grams])

    doc_places = marked.select("doc_id", "text_hash", "words", F.explode(places(F.col("words"))).alias("p")).select(
        "doc_id", "text_hash", "words", "p.print", F.col("p.at").alias("doc_at"))
    item_places = cut_lineage(
        items.select("item_id", "item_words", "prints", F.explode(places(F.col("item_words"))).alias("p"))
        .filter(F.array_contains("prints", F.col("p.print")))
        .select("item_id", "item_words", "p.print", F.col("p.at").alias("item_at"))
    )
    size = F.size("item_words")
    begins = F.col("doc_at") - F.col("item_at")
    aligned = doc_places.join(small(item_places), "print").select(
        "doc_id", "text_hash", "item_id", "item_words", begins.alias("begins"),
        F.slice("words", F.greatest(begins, F.lit(0)) + 1, F.when(begins < 0, size + begins).otherwise(size)).alias("beside"),
    ).dropDuplicates(["doc_id", "text_hash", "item_id", "begins"])
    skipped = F.greatest(-F.col("begins"), F.lit(0))
    equal = F.transform(F.col("item_words"), lambda w, i: F.coalesce(w == F.get("beside", i - skipped), F.lit(False)))
    return (
        aligned.withColumn("run", F.explode(_runs(F.least(size, F.lit(window)), equal)))
        .select("doc_id", "text_hash", "item_id", (F.col("begins") + F.col("run.first")).alias("first"),
                (F.col("begins") + F.col("run.end")).alias("end"))
        .distinct()
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: ``doc_id``, ``text_hash``, ``n_words``, ``n_hit``, ``items`` (sorted as strings), ``spans``, ``contaminated``.

    Words are runs of ASCII letters, digits and non-ASCII characters with A-Z lower-cased; null has none. A
    document word is hit if it lies in an occurrence of ``window`` consecutive item words, or of a whole item
    of fewer. Items without words never occur; items with the same ``item_id`` count once. Repeated rows get the
    same result each. Fingerprints of the benchmark are broadcast only if their table is small.
    """
    spans = contaminated_spans(docs, benchmark, window)
    found = spans.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("first", "end"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    # covered words: spans in order, each adding what lies beyond the furthest end so far
    hit = F.aggregate("spans", F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")), lambda state, s: F.struct(
        F.greatest(state["to"], s["end"]).alias("to"),
        (state["n"] + F.greatest(s["end"] - F.greatest(s["first"], state["to"]), F.lit(0))).alias("n")))["n"]
    found = found.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "spans", "items", hit.alias("n_hit"))
    sized = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(folded_words(F.col("text"))).cast("long").alias("n_words"))
    joined = sized.join(found, sized["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
    return joined.select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans", F.col("n_hit").isNotNull().alias("contaminated"),
    )
