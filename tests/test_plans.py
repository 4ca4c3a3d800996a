from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.fixtures import PIVOT_YEARS, PORTAL_CHECK, WORKBOOK_CHECK, portal_tables
from tallyport.sources.snapshots import published_table
from tallyport.operators import metrics
from tallyport.plans import institution_statistics as statistics
from tallyport.plans import selection, workbook
from tallyport.sources.csv import read_pipe_csv

SF_DIR = "/root/testdata/sf0.001"


def test_parsing():
    assert selection.parse_years(None) is None and selection.parse_years("") is None
    assert selection.parse_years("2021") == (2021,) and selection.parse_years("2021,2022") == (2021, 2022)
    with pytest.raises(ValueError):
        selection.parse_years("2021,x")
    assert selection.parse_institutions(None) is None
    assert selection.parse_institutions("A, B;C") == ("A, B", "C")


def test_selection_checks(spark):
    usage = spark.createDataFrame([(2021,)], "year int")
    known = spark.createDataFrame([("A",)], "institution_name string")
    selection.check_selection(usage, known, ["A"], [2021])
    selection.check_selection(usage, known, None, None)
    with pytest.raises(ValueError, match="'B'"):
        selection.check_selection(usage, known, ["A", "B"], None)
    with pytest.raises(ValueError, match=r"\[1999, 2030\]"):
        selection.check_selection(usage, known, None, [2030, 2021, 1999])
    with pytest.warns(UserWarning, match="2030"):
        selection.check_selection(usage, known, None, [2030])


def test_institution_statistics(spark, tmp_path):
    out = str(tmp_path / "out")
    tables = portal_tables(spark, SF_DIR)
    found = statistics.institution_statistics(tables, out, PORTAL_CHECK, ["NATION_11", "Nation 3, North "])
    per_status = read_pipe_csv(spark, f"{out}/input_csv/{statistics.PER_STATUS}")
    subscriptions = read_pipe_csv(spark, f"{out}/{statistics.SUBSCRIPTIONS}")
    assert per_status.columns == ["labo_name", "statut", "nb_subscribers"]
    assert per_status.agg(F.sum("nb_subscribers")).first()[0] == subscriptions.where("statut IS NOT NULL").count()
    usage = read_pipe_csv(spark, f"{out}/{statistics.USAGE}")
    assert usage.agg(F.sum("nb_codes")).first()[0] == found.laboratory.agg(F.sum("nb_codes")).first()[0]

    bars = spark.read.parquet(f"{out}/charts/bars")
    assert {r[0] for r in bars.select("institution_folder").distinct().collect()} == {"NATION_11", "Nation_3_North"}
    pages = spark.read.parquet(f"{out}/pages")
    assert {r[0] for r in pages.select("institution").distinct().collect()} == {"nation_11", "nation 3, north"}
    assert pages.where(F.size("lines") > 10).count() == 0
    assert spark.read.parquet(f"{out}/charts/users_per_month").count() == found.all.count()
    with pytest.raises(ValueError):
        statistics.institution_statistics(tables, out, replace(PORTAL_CHECK, years=(1997, 2050)), strict=True)


def test_folder_report(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name|n\nNation_1 x|1\nNATION_2|\nother|3\n")
    log = portal_tables(spark, SF_DIR).usage_log
    every = statistics.folder_report(spark, str(tmp_path), log)
    assert sorted((r["title"], tuple(r["lines"])) for r in every.collect()) == [
        ("nation_1 (1/1)", ("Nation_1 x | 1",)), ("nation_2 (1/1)", ("NATION_2 | ",)),
    ]
    one = statistics.folder_report(spark, str(tmp_path), log, " OTHER ")
    assert [(r["title"], r["lines"]) for r in one.collect()] == [("other (1/1)", ["other | 3"])]


def test_workbook(spark, tmp_path):
    out = str(tmp_path / "out")
    workbook.publish_workbook(portal_tables(spark, SF_DIR), out, WORKBOOK_CHECK)
    charts = workbook.workbook_charts(spark, out)
    pivot = charts["total_codes_by_month"]
    assert pivot.columns == ["month", "month2", *map(str, PIVOT_YEARS)] and pivot.count() == 12
    total = sum(pivot.agg(F.sum(F.col(f"`{y}`"))).first()[0] for y in PIVOT_YEARS)
    institutions = published_table(spark, f"{out}/institution_monthly_sum_of_codes")  # its newest version
    named = institutions.agg(F.sum("sum_of_codes")).first()[0]
    assert 0 < named <= total
    assert charts["unique_users_by_month"].first()["period"].startswith("1996-")
    years = [r["year"] for r in charts["institution_codes"].collect()]
    assert years == sorted(years)
    assert metrics.active_years(institutions).count() == len(PIVOT_YEARS)
