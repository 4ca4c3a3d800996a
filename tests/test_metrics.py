import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyport.config import PORTAL, WORKBOOK
from tallyport.functions.text import normalize_name
from tallyport.operators import clean, metrics
from tests.portal import line, tables

LOG = [
    line(codes=5), line(codes=7, when="2021-03-05 10:00:00"), line(name=None, codes=1), line(name=None, codes=2),
    line(user=11, name="u11", institution=2, codes=0), line(user=11, name="u11", source="unmapped", codes=3),
    line(user=12, name="u10", institution=2, codes=4, when="2022-12-31 23:00:00"), line(codes=5),
]


@pytest.fixture(scope="module")
def usage(spark):
    return clean.usage(tables(spark, LOG), PORTAL).cache()


def test_codes_per_institution_month(usage, rows):
    assert rows(metrics.codes_per_institution_month(usage)) == sorted([
        ("Alpha ", 2021, 3, "March", dt.date(2021, 3, 1), "Mar21", 18),
        ("beta", 2021, 3, "March", dt.date(2021, 3, 1), "Mar21", 0),
        ("beta", 2022, 12, "December", dt.date(2022, 12, 1), "Dec22", 4),
    ], key=repr)


def test_users(spark, usage, rows):
    expected = [("Alpha ", 2021, 3, "March", 3), ("beta", 2021, 3, "March", 1), ("beta", 2022, 12, "December", 1)]
    assert rows(metrics.users_per_institution_month(usage)) == sorted(expected, key=repr)
    assert rows(metrics.users_all_month(usage)) == [(2021, 3, "March", 4), (2022, 12, "December", 1)]
    repeated = clean.usage_lines(tables(spark, LOG), PORTAL)
    assert rows(metrics.users_per_institution_month(repeated)) == sorted(expected, key=repr)


def test_unique_users_skip_missing_names(usage, rows):
    assert rows(metrics.unique_users_month(usage)) == [
        (2021, "03 - March", "March", 2), (2022, "12 - December", "December", 1),
    ]
    nobody = usage.withColumn("user_name", F.lit(None).cast("string")).where("year = 2022")
    assert rows(metrics.unique_users_month(nobody)) == [(2022, "12 - December", "December", 0)]


def test_codes_per_database_year(usage, rows):
    found = metrics.codes_per_institution_database_year(usage)
    assert rows(found) == [("Alpha ", "ESG", 2021, 15), ("beta", "ESG", 2021, 0), ("beta", "ESG", 2022, 4)]
    assert rows(metrics.positive_codes(found)) == [("Alpha ", "ESG", 2021, 15), ("beta", "ESG", 2022, 4)]
    assert rows(metrics.slice_metric(found, "beta", ["2021", 2023])) == [("beta", "ESG", 2021, 0)]


def test_active_years(usage, rows):
    assert rows(metrics.active_years(usage)) == [(2021,), (2022,)]
    assert rows(metrics.active_years_per_institution(usage)) == [("Alpha ", 2021), ("beta", 2021), ("beta", 2022)]


SUBSCRIPTION = (
    "id_user bigint, labo_name string, date_created date, date_last_access date, statut string, "
    "date_create_year int, date_last_access_year int"
)


@pytest.fixture(scope="module")
def subscriptions(spark):
    day, other = dt.date(2020, 1, 1), dt.date(2021, 1, 1)
    return spark.createDataFrame([
        (10, "A", day, day, "PhD", 2020, 2020), (10, "B", day, other, "PhD", 2020, 2021),
        (10, "B", day, other, None, 2020, 2021), (11, "A", other, None, "PhD", 2021, None),
    ], SUBSCRIPTION)


def test_subscriber_counts(subscriptions, rows):
    assert rows(metrics.subscribers_per_status(subscriptions)) == [("A", "PhD", 2), ("B", "PhD", 1)]
    assert rows(metrics.subscribers_per_create_year(subscriptions)) == [
        ("A", "PhD", 2020, 1), ("A", "PhD", 2021, 1), ("B", "PhD", 2020, 1),
    ]
    assert rows(metrics.subscribers_per_access_year(subscriptions)) == [("A", "PhD", 2020, 1), ("B", "PhD", 2021, 1)]


def plain_workbook(usage, subscriptions):
    """Every log line joined to every subscription, in Python."""
    by_user = {}
    for s in subscriptions.collect():
        by_user.setdefault(s["id_user"], []).append(s)
    return [(u, s) for u in usage.collect() for s in by_user.get(u["id_user"], [None])]


def sums(pairs, key):
    found = {}
    for u, s in pairs:
        k = key(u, s)
        if k is not None and None not in k:
            found[k] = found.get(k, 0) + u["nb_codes"]
    return sorted((*k, v) for k, v in found.items())


def test_workbook_sums_fan_out(spark, subscriptions):
    usage = clean.usage(tables(spark, LOG + [line(user=13, name=None, institution=3, codes=100)]), WORKBOOK)
    pairs = plain_workbook(usage, subscriptions)
    found = metrics.codes_month(usage, subscriptions).collect()
    assert sorted((r.year, r.month2, r.sum_of_codes) for r in found) == sums(pairs, lambda u, s: (u["year"], u["month2"]))
    found = metrics.institution_monthly_codes(usage, subscriptions).collect()
    assert sorted((r.institution_name, r.database_name, r.year, r.month2, r.sum_of_codes) for r in found) == sums(
        pairs, lambda u, s: (u["institution_name"], u["database_name"], u["year"], u["month2"])
    )
    found = metrics.user_monthly_codes(usage, subscriptions).collect()
    assert sorted((r.user_full, r.statut, r.database_name, r.year, r.month2, r.sum_of_codes) for r in found) == sums(
        pairs, lambda u, s: (
            f"{u['user_name'] or 'Unknown User'} - {u['institution_name'] or 'Unknown Institution'}",
            s and s["statut"], u["database_name"], u["year"], u["month2"],
        )
    )


def test_pivot_has_all_months(spark, rows):
    monthly = spark.createDataFrame(
        [(2021, "March", 5), (2022, "March", 7), (2021, "January", 1)], "year int, month2 string, sum_of_codes bigint"
    )
    found = metrics.month_by_year_pivot(monthly).orderBy("month").collect()
    assert [r["month2"] for r in found][:3] == ["January", "February", "March"] and len(found) == 12
    assert [(r["2021"], r["2022"]) for r in found[:3]] == [(1, 0), (0, 0), (5, 7)]
    assert metrics.month_by_year_pivot(monthly, [2022, 2030]).columns == ["month", "month2", "2022", "2030"]


def test_lookups(usage, subscriptions, rows):
    assert rows(metrics.databases_per_user(usage)) == [(10, ["ESG"]), (11, ["ESG"]), (12, ["ESG"])]
    joined = clean.usage_subscription(usage, subscriptions)
    assert rows(metrics.users_per_database(joined, normalize_name("database_name2"))) == [("esg", "u10"), ("esg", "u11")]
    assert rows(metrics.users_per_institution(joined, normalize_name("labo_name"))) == [
        ("a", "u10"), ("a", "u11"), ("b", "u10"),
    ]
    assert rows(metrics.databases_per_institution(joined, normalize_name("labo_name"))) == [("a", "ESG"), ("b", "ESG")]
    day, other = dt.date(2020, 1, 1), dt.date(2021, 1, 1)
    assert rows(metrics.user_profile_dates(joined)) == [(10, [day], [day, other]), (11, [other], [])]


def test_unknown_institutions(spark, rows):
    known = spark.createDataFrame([("A",), ("b ",)], "institution_name string")
    asked = spark.createDataFrame([("A",), ("a",), ("b",), ("b",)], "institution_name string")
    assert rows(metrics.unknown_institutions(asked, known)) == [("a",), ("b",)]
    with pytest.raises(ValueError, match="'a', 'b'"):
        metrics.require_institutions(asked, known)
    metrics.require_institutions(known, known)


def test_years_without_data(spark, usage, rows):
    asked = spark.createDataFrame([(2021,), (2030,), (2030,)], "year int")
    assert rows(metrics.years_without_data(asked, usage)) == [(2030,)]


def test_sort_puts_missing_last_and_upper_case_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("B",), ("É",)], "x string")
    assert [r.x for r in metrics.sorted_nulls_last(df, ["x"]).collect()] == ["B", "a", "b", "É", None]


def test_invariants(spark, usage, subscriptions):
    def total(df, column):
        return df.agg(F.sum(column)).first()[0]

    assert total(metrics.codes_per_institution_month(usage), "nb_codes") == total(usage, "nb_codes")
    known = subscriptions.where("date_last_access_year IS NOT NULL")
    assert total(metrics.subscribers_per_status(known), "nb_subscribers") == total(
        metrics.subscribers_per_access_year(known), "nb_subscribers"
    ) == total(metrics.subscribers_per_create_year(known), "nb_subscribers")
