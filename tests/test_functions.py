import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyport.config import CONTINENTS, MONTHS
from tallyport.functions import dates, labels, text


def values(spark, kind, data, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", expression).collect())]


def test_source_class(spark):
    cases = {
        "actions": None, "actions_x": "Stocks", "actionsX": "Stocks", "histo_actions": "Stocks",
        "indices_telekurs": "Global\\Market Indices", "histo_indices_telekurs": "Global\\Market Indices",
        "histo_indices_eurofidai": "Eurofidai Indices", "ost_x": "Corporate Events", "x_ost": None,
        "x_histo_ost": "Corporate Events", "ESG": None, "esg": "ESG", "fonds_mutuel": None,
        "fonds_mutuel_a": "Mutual Funds", "corres_code": "Code Mapping Table", "taux_change": "Spot Exchange Rate",
        "greenbonds": "Green Bonds", None: None,
    }
    assert values(spark, "string", cases, labels.source_class("v")) == list(cases.values())


def test_search_or_extract(spark):
    found = values(spark, "string", ["histo_x", "x", None], labels.search_or_extract("v"))
    assert found == ["Search_Code", "Extract_Data", "Extract_Data"]


def test_request_label(spark):
    found = values(spark, "int", [1, 2, 3, 4, None], labels.request_label("v"))
    assert found == ["prévisualisation", "téléchargement", "téléchargement", None, None]


def test_month_labels(spark):
    assert values(spark, "int", range(1, 13), labels.month_name("v")) == list(MONTHS)
    assert values(spark, "int", [1, 12, None], labels.numbered_month_label("v")) == ["01 - January", "12 - December", None]
    year = F.lit(2023)
    assert values(spark, "int", [1, 11], labels.year_month_key(year, "v")) == ["202301", "202311"]
    assert values(spark, "int", [1, 11], labels.short_month_label(year, "v")) == ["Jan23", "Nov23"]
    assert values(spark, "int", [5], labels.short_month_label(F.lit(2005), "v")) == ["May05"]
    assert values(spark, "string", ["202302", None], labels.first_of_month("v")) == [dt.date(2023, 2, 1), None]
    assert values(spark, "string", ["May", None], labels.period_label(year, "v")) == ["2023-May", None]
    assert values(spark, "string", ["X", None], labels.month_institution_label(F.lit("May"), "v")) == ["May - X", None]


def test_user_institution_label(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)], "u string, i string")
    found = [r[0] for r in df.select(labels.user_institution_label("u", "i")).collect()]
    assert found == ["a - b", "Unknown User - b", "a - Unknown Institution", "Unknown User - Unknown Institution"]


def test_lookups(spark):
    for code, names in CONTINENTS.items():
        assert set(values(spark, "string", names, labels.continent_of("v"))) == {code}
    assert values(spark, "string", ["Atlantis", None], labels.continent_of("v")) == [None, None]
    assert values(spark, "string", ["actions", "indices", "fonds", "x"], labels.instrument_code("v")) == [2, 7, 3, None]
    assert values(spark, "string", ["fonds", "x"], labels.price_table("v")) == ["src_cours_fonds", None]


BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"


def test_normalize_name_follows_python(spark):
    cases = [" Ab C ", "Université É ", BLANKS + "Ünï x" + BLANKS, "", "   ", "​x", "x᠎"]
    assert values(spark, "string", cases, text.normalize_name("v")) == [c.strip().lower() for c in cases]
    assert values(spark, "string", [None], text.normalize_name("v")) == [None]


def test_folder_slug(spark):
    found = values(spark, "string", [" CERAG, Univ Alpes ", "a,b , c", None], text.folder_slug("v"))
    assert found == ["CERAG_Univ_Alpes", "ab__c", None]


def test_safe_path(spark):
    found = values(spark, "string", ['a<b>c:d"e/f\\g|h?i*j k\x00l', "é.csv"], text.safe_path("v"))
    assert found == ["a_b_c_d_e_f_g_h_i_j_k_l", "é.csv"]
    assert values(spark, "string", ["a b"], text.safe_path("v", "-")) == ["a-b"]


def test_safe_filename(spark):
    found = values(spark, "string", ["é à-1.csv", "a/b\\c:d", "²½五_x", "é"], text.safe_filename("v"))
    assert found == ["é à-1.csv", "a_b_c_d", "²½五_x", "e_"]
    first, again, other = values(spark, "string", ["///", "///", ""], text.safe_filename("v"))
    assert first == again != other
    assert first.startswith("empty_name_") and other.startswith("empty_name_")


def test_strip_non_printable(spark):
    found = values(spark, "string", ["a\x00b\x1fc\x7fd\x9fe\n\té", None], text.strip_non_printable("v"))
    assert found == ["abcdeé", None]


def test_row_text(spark):
    df = spark.createDataFrame([(1, None, "x ", dt.date(2020, 1, 2))], "a int, b string, c string, d date")
    assert df.select(text.row_text(df.columns)).first()[0] == "1 |  | x  | 2020-01-02"
    assert df.select(text.header_text(df.columns)).first()[0] == "a | b | c | d"


def test_is_included(spark):
    df = spark.createDataFrame(
        [([], [1]), ([1], [1, 2]), ([3], [1, 2]), ([], []), ([1, 1], [1])], "inner array<int>, outer array<int>"
    )
    assert [r[0] for r in df.select(text.is_included("inner", "outer")).collect()] == [True, True, False, True, True]


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Kiritimati", "America/Los_Angeles"])
def test_epoch_date_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = values(spark, "bigint", [0, 86399, 86400, -1, 1700000000, None], dates.epoch_date("v"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    day = dt.date
    assert found == [day(1970, 1, 1), day(1970, 1, 1), day(1970, 1, 2), day(1969, 12, 31), day(2023, 11, 14), None]


def test_date_and_year(spark):
    date, year = dates.date_and_year("v")
    assert values(spark, "string", ["2020-02-29", None], date) == [dt.date(2020, 2, 29), None]
    assert values(spark, "string", ["2020-02-29", None], year) == [2020, None]


def test_relative_bounds(spark):
    bounds = dates.relative_bounds(dt.date(2024, 3, 10))
    row = spark.range(1).select(*[v.alias(k) for k, v in bounds.items()]).first().asDict()
    assert row == {
        "date_start": dt.date(2024, 2, 24), "date_end": dt.date(2024, 3, 10),
        "month_start": dt.date(2023, 3, 11), "previous_year": "2023", "current_year": "2024",
    }


def test_axis(spark):
    steps = {0: 10, 9: 10, 10: 10, 99: 10, 100: 100, 158: 100, 1250: 1000, 9999999999: 1000000000}
    assert values(spark, "bigint", steps, dates.axis_step("v")) == list(steps.values())
    found = values(spark, "bigint", [100, 101, 50000, 50001], dates.axis_limit("v"))
    assert found == pytest.approx([110, 151.5, 75000, 67501.35])
