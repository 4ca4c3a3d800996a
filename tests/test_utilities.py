import datetime as dt

import pytest

from tallyport.operators import calendars, quality, runlogs


def test_business_calendar(spark):
    bounds = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 10))], "start date, end date")
    days = sorted(r[0] for r in calendars.calendar(bounds).collect())
    assert days == [dt.date(2024, 1, d) for d in (1, 2, 3, 4, 5, 8, 9, 10)]
    assert calendars.calendar(bounds, business_days=False).count() == 10
    assert calendars.calendar(bounds, "7 days", business_days=False).count() == 2


def test_contract(spark):
    df = spark.createDataFrame([("1", "x", "2020-01-01", "y"), ("b", None, "no", "z")], "a string, b string, c string, d string")
    found = quality.check_contract(df, [("a", "int"), ("c", "str"), ("b", "timestamp"), ("d", "str"), ("e", "bool")])
    assert [tuple(r) for r in found.orderBy("position").collect()] == [
        (1, "a", "int", "a", True, True, 1), (2, "c", "str", "b", True, False, 0), (3, "b", "timestamp", "c", True, False, 1),
        (4, "d", "str", "d", True, True, 0), (5, "e", "bool", None, False, False, None),
    ]
    with pytest.raises(ValueError, match="a .*c .*b .*e "):
        quality.require_contract(df, [("a", "int"), ("c", "str"), ("b", "timestamp"), ("d", "str"), ("e", "bool")])
    quality.require_contract(df, [("a", "str"), ("b", "str")])
    with pytest.raises(TypeError):
        quality.check_contract(df, [("a", "uuid")])
    with pytest.raises(ValueError):
        quality.check_contract(df, [])


def test_column_profile(spark, rows):
    df = spark.createDataFrame(
        [(9999, 99999, 999999999, -999999999, 1.5, "añb", True, dt.datetime(2020, 1, 1), None, dt.date(2020, 1, 1)), (1,) * 4 + (None,) * 6],
        "s int, i int, j bigint, b bigint, f double, t string, o boolean, ts timestamp, n string, d date",
    )
    found = {r["column_name"]: r["sql_type"] for r in quality.column_profile(df).collect()}
    assert found == {
        "s": "SMALLINT", "i": "INTEGER", "j": "INTEGER", "b": "BIGINT", "f": "REAL", "t": "VARCHAR(3)",
        "o": "BOOLEAN", "ts": "TIMESTAMP", "n": "VARCHAR(0)", "d": "DATE",
    }
    with pytest.raises(ValueError, match="array"):
        quality.column_profile(spark.createDataFrame([([1],)], "x array<int>"))


def test_narrowed_load(spark, tmp_path):
    df = spark.createDataFrame([(9999, 123456789012, 0.1, "x")], "s bigint, b bigint, f float, t string")
    loaded = quality.load_narrowed(df, str(tmp_path / "t"), dt.date(2024, 1, 2))
    assert loaded.dtypes == [
        ("date_loading", "date"), ("s", "smallint"), ("b", "bigint"), ("f", "double"), ("t", "string"),
    ]
    assert loaded.first()["date_loading"] == dt.date(2024, 1, 2)
    assert quality.narrowed(df).first()["date_loading"] is not None


LOG = """\
20240101 00:00:00 - portal -INFO - start
20240101 00:00:01 - portal -ERROR - ERROR: second
20240101 00:00:02 - portal -ERROR - ERROR: first seen later
20240102 00:00:09 - portal -ERROR - ERROR: second
20240102 00:00:10 - portal -INFO - ERREUR grave"""


@pytest.fixture
def logs(spark, tmp_path):
    (tmp_path / "bad.log").write_text(LOG)
    (tmp_path / "good.log").write_text("".join(f"line {i} ERROR without colon\n" for i in range(1, 31)))
    return runlogs.read_logs(spark, str(tmp_path))


def test_error_digest(logs, rows):
    found = [e for f, e in rows(runlogs.error_digest(logs)) if f == "bad.log"]
    lines = [x[27:] for x in LOG.split("\n") if "ERROR" in x or "ERREUR" in x]
    assert found == sorted(set(lines)) and len(found) == 3


def test_log_status(logs, rows):
    assert rows(runlogs.log_status(logs)) == [
        ("bad.log", "ERROR", 3, "ERROR: second"), ("good.log", "SUCCESS", 0, "SUCCESS - good.log"),
    ]


def test_log_tail(logs):
    found = runlogs.log_tail(logs, 3).orderBy("log_file", "line_no").collect()
    assert [(r["log_file"], r["line_no"], r["shown"], r["total"]) for r in found] == [
        *[("bad.log", i, 3, 5) for i in (3, 4, 5)], *[("good.log", i, 3, 30) for i in (28, 29, 30)],
    ]
    assert [r["line"] for r in found][-1] == "line 30 ERROR without colon"
    assert {(r["shown"], r["total"]) for r in runlogs.log_tail(logs, 7).collect()} == {(5, 5), (7, 30)}
    with pytest.raises(ValueError):
        runlogs.log_tail(logs, 0)


def test_log_tail_limits_before_the_shuffle(logs):
    assert "WindowGroupLimit" in runlogs.log_tail(logs)._jdf.queryExecution().executedPlan().toString()


def test_last_lines(logs):
    assert [r["line"] for r in runlogs.last_lines(logs.where("log_file = 'bad.log'"), 2).collect()] == LOG.split("\n")[-2:]
