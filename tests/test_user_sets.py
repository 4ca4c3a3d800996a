"""Distinct users from merged bitmaps against count(DISTINCT) per level."""

from collections import defaultdict

from tallyport.operators import user_sets

SCHEMA = "institution_name string, user_name string, year int, month int"


def plain(rows):
    sets = defaultdict(set)
    for inst, user, year, month in rows:
        if inst is None or year is None or month is None:
            continue
        sets[("month", inst, year, month)].add(user)
        sets[("year", inst, year, None)].add(user)
        sets[("all", inst, None, None)].add(user)
    return sorted(((*k, len(v)) for k, v in sets.items()), key=repr)


def test_rollup_equals_distinct_counts_across_buckets(spark):
    rows = [(f"i{u % 3}", f"u{u}", 2020 + u % 2, 1 + u % 12) for u in range(70000)]
    rows += [("i0", None, 2020, 1), ("i0", None, 2020, 1), (None, "u1", 2020, 1), ("i1", "u5", None, 3), ("i2", "u7", 2021, None)]
    rows += rows[:100]  # repeated lines
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = sorted((tuple(r) for r in user_sets.user_rollup(df).collect()), key=repr)
    assert got == plain(rows)


def test_rollup_of_an_empty_log(spark):
    assert user_sets.user_rollup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_levels_are_checked(spark):
    import pytest

    with pytest.raises(ValueError):
        user_sets.user_counts(spark.createDataFrame([], SCHEMA), ["institution_name"], "week")
