import pytest
from pyspark.sql import functions as F

from tallyport.operators.joins import drop_null_keys, fits_broadcast, hot_keys, lookup_join, salted_join
from tallyport.operators.metrics import sorted_nulls_last


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows have one key, some have none."""
    key = F.when(F.col("id") % 3 < 2, F.lit(7)).when(F.col("id") % 100 == 2, F.lit(None)).otherwise(F.col("id") % 50)
    return spark.range(3000).select(key.cast("int").alias("k"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    # two rows for each key, none for some
    return spark.range(40).select((F.col("id") % 20).cast("int").alias("k"), F.col("id").alias("w"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_all_ways_to_join_agree(skewed, lookup, rows, how):
    expected = rows(skewed.join(lookup, "k", how))
    assert rows(salted_join(skewed, lookup, "k", how, salts=5)) == expected
    assert rows(lookup_join(skewed, lookup, "k", how)) == expected
    assert rows(lookup_join(skewed, lookup, "k", how, limit=0)) == expected
    assert rows(lookup_join(skewed, lookup, "k", how, keys=skewed, limit=0)) == expected


def test_salted_join_of_nothing(skewed, lookup):
    assert salted_join(skewed.where("v < 0"), lookup, "k").count() == 0
    assert salted_join(skewed.where("k IS NULL"), lookup, "k", "left").count() == skewed.where("k IS NULL").count()
    assert salted_join(skewed, lookup.where("w < 0"), "k", "left").count() == 3000


def test_hot_keys_are_found_and_bounded(skewed):
    found = {r["k"] for r in hot_keys(skewed, "k", 0.1).collect()}
    assert 7 in found and None not in found and len(found) <= 10


def test_hot_rows_are_spread(spark, skewed, lookup):
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain = largest(skewed.join(lookup, "k"))
        salted = largest(salted_join(skewed, lookup, "k", salts=16))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
    assert plain >= 4000 and salted < plain * 0.6


def test_rows_of_one_key_are_sorted_in_many_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = sorted_nulls_last(spark.range(4000).select(F.lit("A").alias("institution"), "id"), ["institution"])
        sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert max(sizes) < 2000


def test_broadcast_only_within_the_limit(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10000).write.parquet(path)
    stored = spark.read.parquet(path)
    assert fits_broadcast(stored) and not fits_broadcast(stored, 1000)
    small = lookup_join(spark.range(5), stored, "id")._jdf.queryExecution().optimizedPlan().toString()
    large = lookup_join(spark.range(5), stored, "id", limit=1000)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in small and "strategy=broadcast" not in large


def test_drop_null_keys(spark, rows):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert rows(drop_null_keys(df, ["a"])) == sorted([(1, None), (3, 4)], key=repr)
    assert rows(drop_null_keys(df, ["a", "b"])) == [(3, 4)]
