import datetime as dt
from dataclasses import replace

import pytest

from tallyport.config import LEGACY, OPEN_YEARS, PORTAL, WORKBOOK
from tallyport.operators import clean
from tests.portal import at, line, tables


def users(df):
    return sorted(r["id_user"] for r in df.collect())


def test_usage_columns(spark):
    row = clean.with_month_keys(clean.usage(tables(spark, [line(source="histo_ost_eu", kind=3)]), PORTAL)).first()
    assert row.asDict() == {
        "id_user": 10, "user_name": "u10", "id_labo": 1, "institution_name": "Alpha ", "year": 2021, "month": 3,
        "database_name": "histo_ost_eu", "type_interrogation": 3, "nb_codes": 5,
        "date_heure_extraction": at("2021-03-04 10:00:00"), "month2": "March",
        "type_interrogation2": "téléchargement", "database_name2": "Corporate Events",
        "code_ou_data": "Search_Code", "yearmonth": "202103", "date": dt.date(2021, 3, 1), "month_name": "Mar21",
    }


def test_exclusions(spark):
    log = [
        line(user=1), line(user=2, group=None), line(user=3, group="administrateur Drupal"),
        line(user=1178), line(user=594), line(user=4, when="2019-12-31 23:59:59"), line(user=5, institution=3),
        line(user=6, institution=99), line(user=7, when="2020-01-01 00:00:00"), line(user=None), line(user=8, institution=None),
    ]
    found = tables(spark, log)
    assert users(clean.usage(found, PORTAL)) == [1, 7]
    assert users(clean.usage(found, OPEN_YEARS)) == [1, 4, 7]
    assert users(clean.usage(found, LEGACY)) == [1, 5, 6, 7, 8, 594]
    assert users(clean.usage(found, WORKBOOK)) == [1, 5, 6, 8, 594]
    assert users(clean.usage(found, replace(WORKBOOK, years=(2019, 2021)))) == [1, 4, 5, 6, 8, 594]
    assert users(clean.usage(found, replace(PORTAL, years=()))) == []


def test_institution_filter_is_exact(spark):
    log = [line(user=1), line(user=2, institution=2), line(user=3, institution=3)]
    found = tables(spark, log, [(1, "Alpha "), (2, "O'Brien \"x\""), (3, "alpha ")])
    assert users(clean.usage(found, replace(PORTAL, institution="Alpha "))) == [1]
    assert users(clean.usage(found, replace(LEGACY, institution="O'Brien \"x\""))) == [2]
    assert users(clean.usage(found, replace(PORTAL, institution="Alpha"))) == []


def test_identical_lines_count_once(spark):
    log = [line(), line(), line(codes=6)]
    found = tables(spark, log, [(1, "A"), (1, "A"), (1, "B")])
    assert clean.usage(found, PORTAL).count() == 4
    assert clean.usage_lines(found, PORTAL).count() == 6


@pytest.mark.parametrize("limit", [0, None])
def test_usage_by_either_join(spark, rows, monkeypatch, limit):
    log = [line(user=u, institution=1 if u % 3 else 2, codes=u) for u in range(1, 60)]
    found = tables(spark, log)
    expected = sorted(range(1, 60))
    if limit is not None:
        monkeypatch.setattr("tallyport.operators.joins.fits_broadcast", lambda *_: False)
    assert users(clean.usage(found, PORTAL)) == expected


def test_subscription(spark, rows):
    found = tables(
        spark, [line()],
        account=[(10, 0, 86400), (11, 1700000000, 0), (12, 5, 5), (1922, 5, 5), (13, 5, 5), (14, None, None)],
        membership=[(10, 1), (10, 2), (10, 2), (11, 2), (12, 3), (1922, 1), (13, 77), (14, 4), (15, 1)],
        institution=[(1, "Alpha "), (2, "beta"), (3, None), (4, "gamma"), (5, "EUROFIDAI")],
        status=[(10, "PhD"), (10, "Student"), (99, "PhD")],
    )
    first, second = dt.date(1970, 1, 1), dt.date(1970, 1, 2)
    created = dt.date(2023, 11, 14)
    assert rows(clean.subscription(found, PORTAL)) == sorted([
        (10, "Alpha ", first, second, "PhD", 1970, 1970), (10, "Alpha ", first, second, "Student", 1970, 1970),
        (10, "beta", first, second, "PhD", 1970, 1970), (10, "beta", first, second, "Student", 1970, 1970),
        (11, "beta", created, first, None, 2023, 1970), (14, "gamma", None, None, None, None, None),
    ], key=repr)


def test_subscription_exclusions_by_profile(spark):
    found = tables(
        spark, [line()], account=[(u, 0, 0) for u in (1, 2, 3, 274)],
        institution=[(1, "probesys2 probesys"), (2, "administrateur Drupal"), (3, "x")],
        membership=[(1, 1), (2, 2), (3, 3), (274, 3)],
    )
    assert users(clean.subscription(found, PORTAL)) == [3]
    assert users(clean.subscription(found, WORKBOOK)) == [1, 3, 274]


def test_fan_out(spark):
    found = tables(spark, [line(), line(user=11)], membership=[(10, 1), (10, 2)])
    joined = clean.usage_subscription(clean.usage(found, PORTAL), clean.subscription(found, PORTAL))
    assert sorted((r["id_user"], r["labo_name"]) for r in joined.collect()) == [(10, "Alpha "), (10, "beta")]
    assert "institution_name" not in joined.columns


def test_year_filter_reaches_the_scan(spark, tmp_path):
    source = tables(spark, [line(), line(when="2018-01-01 00:00:00")])
    path = str(tmp_path / "log")
    source.usage_log.write.parquet(path)
    stored = replace(source, usage_log=spark.read.parquet(path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = clean.usage(stored, PORTAL)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(requested_at,2020-01-01" in pushed
    assert "Not(In(group_name" in pushed and "Not(In(user_id" in pushed
