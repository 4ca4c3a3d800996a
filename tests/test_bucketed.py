"""Joins of tables bucketed by user: same rows as the plain join, no exchange, a hot user spread over buckets."""

from pyspark.sql import functions as F

from tallyport.plans import bucketed


def test_bucketed_join_equals_plain_join_without_exchange(spark):
    usage = spark.createDataFrame(
        [(u % 50 if u % 3 else 7, f"line {u}", "inst") for u in range(3000)] + [(None, "no user", "inst")],
        "id_user int, request string, institution_name string")
    subs = spark.createDataFrame([(u, f"status {u % 4}") for u in range(0, 60, 2)] + [(7, "second")], "id_user int, statut string")
    staged_usage, staged_subs = bucketed.stage_for_user_joins(usage, subs, 6, salts=4)
    joined = bucketed.usage_subscription_bucketed(staged_usage, staged_subs)
    plain = usage.drop("institution_name").join(subs, "id_user")
    assert sorted(map(tuple, joined.select(*plain.columns).collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bucketed.usage_subscription_bucketed(staged_usage, staged_subs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    # the hot user 7 (a third of the lines) lies in several buckets
    hot = staged_usage.where("id_user = 7").select(F.spark_partition_id().alias("p"), "salt").distinct().count()
    assert hot > 1
