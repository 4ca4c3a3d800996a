import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyport.config import REPORT_COLUMNS
from tallyport.operators import metrics, paging, reports, search

NAMES = [
    "University of Lyon", "University of Lyon 2", "university of", "Univ", "é", "CERAG, Université ", " ", None,
    "aaaaaaa", "aaaaaaaa", "2021-03", "a|b", "\U0001f600\U0001f601x", "nation_1", "nation_10", "10",
]
CELLS = [
    "UNIVERSITY OF LYON 2", " university of lyon", "the university of nowhere", "É", "cerag, université x", None, "",
    "aaaaaaaaaaaa", "xaaaaaaay", "A|B", "z\U0001f600\U0001f601xy", "nation_10", "nation_1 nation_10", "10", "line\nuniv\nline",
]


def brute_force(data, names):
    needles = {n.strip().lower() for n in names if n is not None} - {""}
    return sorted(
        ((*row, needle) for row in data for needle in needles
         if any(cell is not None and needle in str(cell).strip().lower() for cell in row)),
        key=repr,
    )


@pytest.fixture(scope="module")
def cells():
    random.seed(3)
    return [
        (i, random.choice(CELLS), random.choice(CELLS), random.choice([dt.date(2021, 3, 1), None])) for i in range(200)
    ]


@pytest.mark.parametrize("limit", [None, 0])
def test_contains_join_equals_brute_force(spark, rows, cells, limit):
    df = spark.createDataFrame(cells, "i int, a string, b string, d date")
    names = spark.createDataFrame([(n,) for n in NAMES], "institution_name string")
    needles = names if limit is None else search.prepare_names(names, limit)
    assert rows(search.contains_join(df, needles)) == brute_force(cells, NAMES)


def test_contains_join_in_long_texts(spark, rows):
    random.seed(4)
    words = ["lorem", "ipsum", "dolor", "sit", "amet"]
    texts = [(i, " ".join(random.choices(words, k=3000)) + (" a needle here" if i % 3 else "")) for i in range(9)]
    df = spark.createDataFrame(texts, "i int, t string")
    names = spark.createDataFrame([("Needle Here",), ("lorem lorem lorem ipsum ipsum",)], "institution_name string")
    expected = brute_force(texts, ["Needle Here", "lorem lorem lorem ipsum ipsum"])
    assert rows(search.contains_join(df, names, ["t"])) == expected


def test_contains_join_without_names(spark):
    df = spark.createDataFrame([(1, "x")], "i int, a string")
    empty = search.contains_join(df, spark.createDataFrame([(None,), ("  ",)], "institution_name string"))
    assert empty.columns == ["i", "a", "institution"] and empty.count() == 0


def test_contains_join_compares_no_cross_product(spark):
    """Names with one common beginning must not meet every row that has it."""
    df = spark.range(300).select(F.concat(F.lit("university of town "), F.col("id").cast("string")).alias("a"))
    names = df.select(F.col("a").alias("institution_name"))
    plan = search.contains_join(df, names)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    needles = names.select(F.col("institution_name").alias("institution"))
    per_piece = search._anchors(needles).groupBy("piece").count().agg(F.max("count")).first()[0]
    assert per_piece <= 12


def test_any_cell_contains(spark, rows, cells):
    df = spark.createDataFrame(cells, "i int, a string, b string, d date")
    names = [" UNIV ", "2021-03"]
    expected = sorted({r[0] for r in brute_force(cells, names)})
    assert sorted(r[0] for r in df.where(search.any_cell_contains(df.columns, names)).collect()) == expected
    assert df.where(search.any_cell_contains(df.columns, [])).count() == 0


def test_keep_listed_columns(spark, rows):
    df = spark.createDataFrame([(1, 2), (1, 3)], "a int, b int")
    assert rows(search.keep_listed_columns(df, ["a", "x"])) == [(1,)]


def test_distinct_names(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("a ",)], "g string")
    assert rows(search.distinct_names(df, "g")) == [("a ",), ("a",)]


def test_whole_doubles(spark):
    df = spark.createDataFrame(
        [(2022.0, 2022.5, None, 1e300, math.nan, 1), (None, 1.0, None, 1.0, 1.0, 2)],
        "w double, h double, e double, big double, nan double, i int",
    )
    kinds = dict(reports.whole_doubles_to_bigint(df).dtypes)
    assert kinds == {"w": "bigint", "h": "double", "e": "bigint", "big": "double", "nan": "double", "i": "int"}


def test_numbered_rows(spark):
    random.seed(5)
    # one block has most of the rows
    data = [("hot" if i % 3 else f"b{i % 4}", f"{random.random():.12f}") for i in range(2000)] + [("one", "x"), ("nil", None)]
    df = spark.createDataFrame(data, "g string, x string").repartition(8)
    expected = {}
    for g, x in data:
        expected.setdefault(g, []).append(x)
    found = {}
    for r in paging.numbered_rows(df, ["g"], ["x"]).collect():
        found.setdefault(r["g"], {})[r["row_no"]] = (r["x"], r["block_rows"])
    assert {g: [v[i][0] for i in range(1, len(v) + 1)] for g, v in found.items()} == {
        g: sorted(v, key=str) for g, v in expected.items()
    }
    assert all(n == len(expected[g]) for g, v in found.items() for _, n in v.values())


@pytest.mark.parametrize("count, pages", [(0, []), (10, [10]), (11, [10, 1]), (25, [10, 10, 5])])
def test_pages(spark, count, pages):
    df = spark.createDataFrame([("A", "f.csv", "c", f"{i:03d}") for i in range(count)],
                               "institution string, file string, columns string, line string")
    found = reports.report_pages(df).orderBy("page").collect()
    assert [len(r["lines"]) for r in found] == pages
    assert [r["title"] for r in found] == [f"A ({i}/{len(pages)})" for i in range(1, len(pages) + 1)]
    assert [x for r in found for x in r["lines"]] == [f"{i:03d}" for i in range(count)]


def test_report_blocks(spark, rows):
    users = "stats_all_users_with_subscription_informations.csv"
    day = dt.date(2020, 1, 1)
    files = {
        users: spark.createDataFrame(
            [(1, "n", "Alpha ", None, day, day, 5), (1, "n", "Alpha ", None, day, day, 6), (2, "m", "x", "alpha", day, day, 9)],
            "id_user int, user_name string, labo_name string, statut string, date_last_access date, date_created date, nb_codes int",
        ),
        "other.csv": spark.createDataFrame(
            [("beta alpha", 2022.0, 1.5), ("BETA", 2022.5, None), ("alpha", None, 2.0), ("zeta", 2021.25, 0.1)],
            "name string, year double, x double",
        ),
    }
    names = spark.createDataFrame([("ALPHA",), ("beta",), ("9",)], "institution_name string")
    header = " | ".join(REPORT_COLUMNS[users])
    assert rows(reports.report_blocks(files, names)) == sorted([
        ("alpha", users, header, "1 | n | Alpha  |  | 2020-01-01 | 2020-01-01"),
        ("alpha", users, header, "2 | m | x | alpha | 2020-01-01 | 2020-01-01"),
        ("alpha", "other.csv", "name | year | x", "beta alpha | 2022 | 1.5"),
        ("alpha", "other.csv", "name | year | x", "alpha |  | 2.0"),
        ("beta", "other.csv", "name | year | x", "beta alpha | 2022.0 | 1.5"),
        ("beta", "other.csv", "name | year | x", "BETA | 2022.5 | "),
    ], key=repr)
    with pytest.raises(ValueError):
        reports.report_blocks({}, names)


def test_bar_chart_frames(spark, rows):
    months = spark.createDataFrame(
        [("A", 2021, 1, "January", 158), ("A", 2021, 2, "February", 60000), ("A", 2021, 3, "March", 0)],
        "institution_name string, year int, month int, month2 string, nb_codes bigint",
    )
    users = spark.createDataFrame([("A", 2021, 1, "January", 3)],
                                  "institution_name string, year int, month int, month2 string, nb_users bigint")
    bases = spark.createDataFrame([("A", "ESG", 2021, 150), ("A", "Stocks", 2021, -1)],
                                  "institution_name string, database_name2 string, year int, nb_codes bigint")
    assert rows(reports.bar_chart_frames(months, users, bases)) == sorted([
        ("codes_per_month", "A", 2021, 1, "January", 158, 10000, 81000.0),
        ("codes_per_month", "A", 2021, 2, "February", 60000, 10000, 81000.0),
        ("users_per_month", "A", 2021, 1, "January", 3, 10, 13.0),
        ("codes_per_database", "A", 2021, None, "ESG", 150, 100, 225.0),
    ], key=repr)
    assert reports.bar_chart_frames(months, users, bases, positive_only=False).count() == 6


def test_chart_orders(spark):
    monthly = spark.createDataFrame(
        [("B", "d", 2021, "04 - April", "April", 1), ("A", "d", 2021, "04 - April", "April", 2),
         ("A", "d", 2021, "01 - January", "January", 3), ("A", "d", 2020, "12 - December", "December", 4)],
        "institution_name string, database_name string, year int, month_full string, month2 string, sum_of_codes bigint",
    )
    activity = reports.institution_activity_order(reports.institution_activity(monthly)).collect()
    assert [(r["year"], r["label"]) for r in activity] == [
        (2020, "December - A"), (2021, "April - A"), (2021, "April - B"), (2021, "January - A"),
    ]
    unique = monthly.select("year", "month_full", "month2", F.lit(1).alias("nb_unique_users")).distinct()
    ordered = reports.calendar_order(reports.unique_users_periods(unique)).collect()
    assert [r["period"] for r in ordered] == ["2020-December", "2021-January", "2021-April"]
    line = reports.users_line_chart(metrics.users_all_month(spark.createDataFrame(
        [("A", "u", 2021, 3)], "institution_name string, user_name string, year int, month int"
    )))
    assert tuple(line.first()) == (2021, 3, "March", 1)
