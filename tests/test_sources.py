import datetime as dt

import pytest

from tallyport.operators.clean import PortalTables
from tallyport.sources import csv, files, queries, snapshots

NAMES = [("Alpha ", "PhD", 1), ("CERAG, Université", None, 2), (None, "x", 3), (' "q" ', "y", 4)]
SCHEMA = "labo_name string, statut string, nb_subscribers int"


@pytest.fixture(scope="module")
def counts(spark):
    return spark.createDataFrame(NAMES, SCHEMA)


def test_pipe_csv_round_trip(spark, counts, rows, tmp_path):
    path = str(tmp_path / "a.csv")
    csv.write_pipe_csv(counts.coalesce(1), path)
    assert files.first_line(spark, path) == "labo_name|statut|nb_subscribers"
    assert rows(csv.read_pipe_csv(spark, path, SCHEMA)) == sorted(NAMES, key=repr)
    assert dict(csv.read_pipe_csv(spark, path).dtypes)["nb_subscribers"] == "bigint"


def test_read_csv(spark, rows, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a;b;c\n1;;x\n2;2.5;\n")
    name, df = csv.read_csv(spark, str(path), "t", ";")
    assert name == "t" and df.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string")]
    assert rows(df) == [(1, None, "x"), (2, 2.5, None)]
    for bad in (lambda: csv.read_csv(spark, str(path), ""), lambda: csv.read_csv(spark, str(path), "t", "|"),
                lambda: csv.read_csv(spark, str(tmp_path / "no.csv"), "t")):
        with pytest.raises(ValueError):
            bad()


def test_types_by_content(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        "i,w,f,b,t,n,big,mix,suffix,date\n"
        "1,1.0,1.5,True,x,NA,12345678901234567,1,1d,2020-01-01\n"
        "NA,2.0,1e3,false,None,,9,a,2d,2020-01-02\n"
        "-3,,null,NaN,N/A,nan,8,2,3,n/a\n"
    )
    _, df = csv.read_csv(spark, str(path), "t")
    assert dict(df.dtypes) == {
        "i": "bigint", "w": "bigint", "f": "double", "b": "boolean", "t": "string", "n": "string", "big": "bigint",
        "mix": "string", "suffix": "string", "date": "string",
    }
    assert [tuple(r) for r in df.orderBy("i").collect()][0] == (None, 2, 1000.0, False, None, None, 9, "a", "2d", "2020-01-02")
    assert df.where("big = 12345678901234567").count() == 1
    assert dict(csv.read_delimited(spark, str(path), ",").dtypes)["w"] == "double"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        csv.read_delimited(spark, str(path), ",", "i int, w double, f double, b boolean, t string, n string, "
                           "big bigint, mix int, suffix string, date date").collect()


def test_read_csv_folder(spark, rows, tmp_path):
    for i in (1, 2):
        (tmp_path / f"part_{i}.csv").write_text(f"a,b\n{i},x\n")
    (tmp_path / "other.csv").write_text("z\n1\n")
    name, df = csv.read_csv_folder(spark, str(tmp_path), "t", "part_*.csv")
    assert name == "t" and rows(df) == [(1, "x"), (2, "x")]
    with pytest.raises(FileNotFoundError):
        csv.read_csv_folder(spark, str(tmp_path), "t", "*.tsv")
    for args in ((str(tmp_path / "no"), "t"), (str(tmp_path), "t", ""), (str(tmp_path), 3)):
        with pytest.raises(ValueError):
            csv.read_csv_folder(spark, *args)


def test_write_csv_adds_the_suffix(spark, counts, rows, tmp_path):
    assert csv.write_csv(counts, str(tmp_path / "deep" / "a")) == str(tmp_path / "deep" / "a.csv")
    assert csv.write_csv(counts, str(tmp_path / "b.csv")) == str(tmp_path / "b.csv")
    back = spark.read.option("header", True).schema(SCHEMA).csv(str(tmp_path / "b.csv"))
    assert back.count() == 4 and back.where("labo_name = 'Alpha '").count() == 1


def test_scan_pipe_folder(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("x|y\n1|2\n")
    (tmp_path / "b c+.csv").write_text("x|y\n3|\n")
    (tmp_path / "d.csv").write_text("y|z\n5|6\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "note.txt").write_text("x|y\n9|9\n")
    csv.write_pipe_csv(spark.createDataFrame([("7", "8")], "x string, y string"), str(tmp_path / "folder.csv"))
    found, skipped = csv.scan_pipe_folder(spark, str(tmp_path))
    assert rows(found.select("file", "x", "y", "z")) == sorted([
        ("a.csv", "1", "2", None), ("b c+.csv", "3", None, None), ("d.csv", None, "5", "6"), ("folder.csv", "7", "8", None),
    ], key=repr)
    assert skipped == {"empty.csv": "no header"}
    assert sorted(csv.read_pipe_folder(spark, str(tmp_path))) == ["a.csv", "b c+.csv", "d.csv", "folder.csv"]


def test_queries(spark, counts, rows):
    counts.createOrReplaceTempView("counts_view")
    assert rows(queries.run_query(spark, "SELECT count(*) FROM counts_view")) == [(4,)]
    bound = queries.run_query(spark, "SELECT nb_subscribers FROM {c} WHERE statut = :s", {"s": "x' OR '1'='1"}, c=counts)
    assert rows(bound) == []
    assert rows(queries.run_query(spark, "SELECT nb_subscribers FROM {c} WHERE statut = :s", {"s": "x"}, c=counts)) == [(3,)]
    for empty in ("", "  ", None):
        with pytest.raises(ValueError):
            queries.run_query(spark, empty)
    with pytest.raises(Exception, match="no_such_table"):
        queries.run_query(spark, "SELECT * FROM no_such_table").collect()


def test_read_database_checks_its_arguments(spark):
    # a query may now be split (as a derived table); a split with predicates may not
    for kwargs in ({}, {"query": "SELECT 1", "table": "t"}, {"table": "t", "split": ("id", 0, 9, 3), "predicates": ["id < 5"]}):
        with pytest.raises(ValueError):
            queries.read_database(spark, {}, **kwargs)


def test_portal_tables(spark):
    stored = {
        table: spark.createDataFrame([], ", ".join(f"{c} string" for c in [*columns.values(), "extra"]))
        for table, columns in queries.PORTAL_SCHEMA.values()
    }
    found = queries.portal_tables(stored.__getitem__)
    assert isinstance(found, PortalTables)
    assert found.account.columns == ["user_id", "created_s", "access_s"]
    assert found.usage_log.columns == list(queries.PORTAL_SCHEMA["usage_log"][1])


def test_load_table(spark, counts, rows, tmp_path):
    path = str(tmp_path / "counts")
    first = counts.where("nb_subscribers = 1")
    assert rows(snapshots.load_table(spark, first, path, use_saved=True)) == [NAMES[0]]
    assert rows(snapshots.load_table(spark, counts, path, use_saved=True)) == [NAMES[0]]
    assert rows(snapshots.load_table(spark, counts, path)) == sorted(NAMES, key=repr)
    assert rows(snapshots.load_table(spark, first, path, use_saved=True)) == sorted(NAMES, key=repr)
    counts.createOrReplaceTempView("counts_view")
    assert snapshots.extract_table(spark, "counts_view", str(tmp_path / "v.csv")).count() == 4


def test_newest_snapshot(spark, tmp_path):
    root = str(tmp_path)
    for folder in ("raw_2023-12-31", "raw_2024-01-02", "raw_2024-01-02_old", "other_2025-01-01", "raw_latest"):
        (tmp_path / folder / "csv").mkdir(parents=True)
    for name in ("d_2024-01-02-09-00-00.csv", "d_2024-01-02-10-00-00.csv", "notes.csv"):
        (tmp_path / "raw_2024-01-02" / "csv" / name).write_text("a\n1\n")
    assert snapshots.matching_folders(spark, root, "raw_") == ["raw_2023-12-31", "raw_2024-01-02"]
    assert snapshots.newest_folder(spark, root, "raw_").endswith("raw_2024-01-02")
    assert snapshots.newest_snapshot(spark, root, "raw_").endswith("csv/d_2024-01-02-10-00-00.csv")
    assert snapshots.newest_folder(spark, root, "none_") is None
    assert snapshots.newest_snapshot(spark, root, "none_") is None
    with pytest.raises(FileNotFoundError):
        snapshots.newest_folder(spark, root + "/no")


def test_publish_table(spark, counts, tmp_path):
    path = str(tmp_path / "t")
    for df in (counts, counts.limit(1)):
        snapshots.publish_table(df, ["nb_subscribers", "labo_name"], path)
    back = snapshots.published_table(spark, path)
    assert back.columns == ["nb_subscribers", "labo_name"] and back.count() == 1


def test_write_per_institution(spark, counts, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_per_institution(counts, path, "labo_name")
    folders = {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()}
    assert folders == {
        "institution_folder=Alpha", "institution_folder=CERAG_Université", "institution_folder=%22q%22",
        "institution_folder=__HIVE_DEFAULT_PARTITION__",
    }
    assert spark.read.parquet(path).count() == 4


def test_versions(spark, counts, tmp_path):
    label = snapshots.next_version_label
    assert label([], "t") == "t_v001"
    assert label(["t_v001", "t_v009", "t_other_v044", "x_t_v050", "t_v2x"], "t") == "t_v010"
    assert label(["t_v999", "t_v003_20240101"], "t") == "t_v1000"
    assert label(["t_v003_20240101"], "t", dt.date(2024, 2, 9)) == "t_v004_20240209"
    path = str(tmp_path / "t")
    assert [snapshots.write_version(counts.limit(n), path, "t") for n in (1, 2)] == ["t_v001", "t_v002"]
    assert snapshots.write_version(counts, path, "t", dt.date(2024, 2, 9)) == "t_v003_20240209"
    assert [snapshots.read_version(spark, path, f"t_v00{n}").count() for n in (1, 2)] == [1, 2]


def test_publish_that_fails_leaves_the_table_as_it_was(spark, counts, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    columns = ["nb_subscribers", "labo_name"]
    snapshots.publish_table(counts, columns, path)
    before = sorted(map(tuple, snapshots.published_table(spark, path).collect()), key=repr)
    failing = counts.withColumn("nb_subscribers", F.when(F.col("nb_subscribers") > 1, F.raise_error(F.lit("disk gone")))
                                .otherwise(F.col("nb_subscribers")))
    with pytest.raises(Exception):
        snapshots.publish_table(failing, columns, path)
    assert sorted(map(tuple, snapshots.published_table(spark, path).collect()), key=repr) == before
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_staging")]


def test_publish_keeps_the_newest_versions(spark, counts, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        snapshots.publish_table(counts.limit(n), ["nb_subscribers", "labo_name"], path)
    assert snapshots.published_versions(spark, path) == [3, 4]
    assert snapshots.published_table(spark, path).count() == min(4, counts.count())


def test_published_table_reads_a_plain_folder(spark, counts, tmp_path):
    path = str(tmp_path / "plain")
    counts.write.parquet(path)
    assert snapshots.published_table(spark, path).count() == counts.count()


def test_claim_is_exclusive(spark, tmp_path):
    from tallyport.sources import files

    marker = str(tmp_path / "m" / "x")
    assert files.claim(spark, marker) and not files.claim(spark, marker)


def test_two_writers_at_once_get_two_labels(spark, counts, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "v")
    with ThreadPoolExecutor(4) as pool:
        labels = list(pool.map(lambda n: snapshots.write_version(counts.limit(n), path, "t"), [1, 2, 3, 4]))
    assert sorted(labels) == ["t_v001", "t_v002", "t_v003", "t_v004"]
    assert sorted(snapshots.read_version(spark, path, label).count() for label in labels) == sorted(
        min(n, counts.count()) for n in [1, 2, 3, 4])


def test_quarantined_folder_reports_bad_rows_and_files(spark, tmp_path):
    folder = tmp_path / "reports"
    folder.mkdir()
    (folder / "good.csv").write_text('name|n\nAlpha|1\n"Be|ta"|2\nNA|3\n')
    (folder / "ragged.csv").write_text("name|n\nGamma|4\nDelta|5|extra\nEps\n")
    (folder / "typed.csv").write_text("name|n\nZeta|6\nEta|seven\n")
    (folder / "empty.csv").write_text("")
    (folder / "headerless.csv").write_text("\nTheta|8\n")
    (folder / "twice.csv").write_text("a|a\n1|2\n")
    (folder / "quoted.csv").write_text('"a|x"|b\n1|2\n')
    (folder / "notes.txt").write_text("not read")
    read = csv.read_pipe_folder_quarantined(spark, str(folder), {"typed.csv": "name string, n bigint"})
    assert sorted(read.tables) == ["good.csv", "quoted.csv", "ragged.csv", "typed.csv"]
    assert sorted(map(tuple, read.tables["good.csv"].collect()), key=repr) == [("Alpha", 1), ("Be|ta", 2), (None, 3)]
    assert read.tables["quoted.csv"].columns == ["a|x", "b"]
    assert [tuple(r) for r in read.tables["ragged.csv"].collect()] == [("Gamma", 4)]
    assert [tuple(r) for r in read.tables["typed.csv"].collect()] == [("Zeta", 6)]
    assert sorted(map(tuple, read.bad_rows.collect())) == [
        ("ragged.csv", "Delta|5|extra", csv.RAGGED), ("ragged.csv", "Eps", csv.RAGGED), ("typed.csv", "Eta|seven", csv.UNTYPED)]
    assert sorted(map(tuple, read.bad_files.collect())) == [
        ("empty.csv", csv.NO_HEADER), ("headerless.csv", csv.NO_HEADER), ("twice.csv", csv.REPEATED)]


def test_quarantined_folder_of_bad_files_only(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "empty.csv").write_text("")
    read = csv.read_pipe_folder_quarantined(spark, str(folder))
    assert read.tables == {} and read.bad_rows.count() == 0 and read.bad_files.count() == 1


def test_folder_report_goes_on_past_a_bad_file(spark, tmp_path):
    from tallyport.plans import institution_statistics as statistics

    folder = tmp_path / "r"
    folder.mkdir()
    (folder / "a.csv").write_text("labo_name|n\nNorth lab|1\nSouth lab|2\n")
    (folder / "b.csv").write_text("labo_name|n\nNorth lab|1|2\n")
    (folder / "c.csv").write_text("")
    log = spark.createDataFrame([("North lab",)], "group_name string")
    pages, bad_rows, bad_files = statistics.folder_report_quarantined(spark, str(folder), log)
    assert [(r["institution"], r["file"], r["lines"]) for r in pages.collect()] == [("north lab", "a.csv", ["North lab | 1"])]
    assert bad_rows.count() == 1 and bad_files.count() == 1


def test_saved_extract_keeps_texts_that_look_missing(spark, tmp_path):
    rows = [(1, "NA"), (2, "null"), (3, ""), (4, "None"), (5, None), (6, "x")]
    df = spark.createDataFrame(rows, "id bigint, label string")
    path = str(tmp_path / "extract")
    snapshots.load_table(spark, df, path)
    again = snapshots.load_table(spark, spark.createDataFrame([(9, "new")], "id bigint, label string"), path, use_saved=True)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(rows, key=repr)
    assert files.has_rows_written(spark, f"{path}.csv")


def test_saved_extract_of_other_columns_is_stale(spark, tmp_path):
    path = str(tmp_path / "extract")
    snapshots.load_table(spark, spark.createDataFrame([(1, "a")], "id bigint, label string"), path)
    wider = spark.createDataFrame([(2, "b", 3.0)], "id bigint, label string, score double")
    assert [tuple(r) for r in snapshots.load_table(spark, wider, path, use_saved=True).collect()] == [(2, "b", 3.0)]


def test_extract_saved_without_copy_is_read_from_its_csv(spark, tmp_path):
    path = str(tmp_path / "old.csv")
    csv.write_csv(spark.createDataFrame([(1, "NA"), (2, "y")], "id bigint, label string"), path)
    back = snapshots.load_table(spark, spark.createDataFrame([], "id bigint, label string"), path, use_saved=True)
    assert sorted(map(tuple, back.collect()), key=repr) == [(1, None), (2, "y")]


def test_files_without_cells_across_lines_are_read_in_parts(spark, tmp_path):
    plain, quoted = tmp_path / "plain.csv", tmp_path / "quoted.csv"
    plain.write_text("id|name\n" + "".join(f"{i}|name {i} with some padding to make the file longer\n" for i in range(60000)))
    quoted.write_text('id|name\n1|"two\nlines"\n2|"a ""quote"""\n')
    assert csv.split_by_line_breaks(spark, [str(plain), str(quoted)]) == ([f"file:{plain}"], [f"file:{quoted}"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        rows = csv.read_pipe_csv(spark, str(plain), "id bigint, name string")
        assert rows.rdd.getNumPartitions() > 1
        assert rows.count() == 60000 and rows.agg({"id": "sum"}).first()[0] == sum(range(60000))
        both = csv.read_delimited(spark, [str(plain), str(quoted)], "|", "id bigint, name string")
        assert sorted(r["name"] for r in both.where("id < 3").collect()) == ["a \"quote\"", "name 0 with some padding to make the file longer",
                                                                            "name 1 with some padding to make the file longer", "name 2 with some padding to make the file longer",
                                                                            "two\nlines"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parameters_become_typed_literals():
    import datetime as dt

    text = "SELECT * FROM t WHERE name = :name AND day >= :day AND n < :n AND note <> ':kept' AND at < :at AND x IS :nothing"
    bound = queries.bind(text, {"name": "O'Brien", "day": dt.date(2024, 1, 2), "n": 5,
                                "at": dt.datetime(2024, 1, 2, 3, 4, 5), "nothing": None})
    assert bound == ("SELECT * FROM t WHERE name = 'O''Brien' AND day >= DATE '2024-01-02' AND n < 5 AND note <> ':kept' "
                     "AND at < TIMESTAMP '2024-01-02 03:04:05' AND x IS NULL")
    assert queries.bind("SELECT a::int FROM t", {}) == "SELECT a::int FROM t"
    with pytest.raises(KeyError):
        queries.bind("SELECT :a", {})
    with pytest.raises(KeyError):
        queries.bind("SELECT 1", {"a": 1})
    with pytest.raises(ValueError):
        queries.sql_literal(float("nan"))


def test_jdbc_options_split_a_query_and_fetch_in_blocks():
    base = {"url": "jdbc:x://h/db", "user": "u"}
    assert queries.jdbc_options(base, table="t") == {"fetchsize": "10000", "url": "jdbc:x://h/db", "user": "u", "dbtable": "t"}
    split = queries.jdbc_options(base, query="SELECT id FROM t WHERE y = :y", split=("id", 1, 100, 4), params={"y": 2024})
    assert split["dbtable"] == "(SELECT id FROM t WHERE y = 2024) split_source"
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "4")
    assert queries.jdbc_options(base | {"fetchsize": "50"}, table="t")["fetchsize"] == "50"
    with pytest.raises(ValueError):
        queries.jdbc_options(base, table="t", params={"y": 1})


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_folder_scan_parses_its_texts_once(spark, tmp_path, rows):
    folder = tmp_path / "in"
    (folder / "written +1.csv").mkdir(parents=True)
    (folder / "written +1.csv" / "part-0.csv").write_text("a b|c,(d)\n1|2\n\"x\ny\"|\n")
    (folder / "plain.csv").write_text("a b|c,(d)\n3|4\n")
    (folder / "ragged.csv").write_text("a b|c,(d)\n5|6\n7\n8|9|10\n")
    (folder / "other.csv").write_text("e\n11\n")
    scanned, skipped = csv.scan_pipe_folder(spark, str(folder))
    assert scanned.columns == ["file", "a b", "c,(d)", "e"]
    assert rows(scanned) == sorted([
        ("written +1.csv", "1", "2", None), ("written +1.csv", "x\ny", None, None), ("plain.csv", "3", "4", None),
        ("other.csv", None, None, "11")], key=repr)
    assert skipped == {"ragged.csv": "2 rows do not fit the header"}
    # the rows come from the copy that was written when bad rows were counted, not from a second parse
    assert "] csv" not in _plan(scanned) and "] parquet" in _plan(scanned)


def test_quarantine_marks_misfits_when_it_scans(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("one.csv", "two.csv", "free.csv"):
        (folder / name).write_text("s|n|d|when\nx|1|nan|2020-01-31\nNA|NULL||n/a\ny|z|1|2020-02-30\nragged\n")
    schema = "s string, n bigint, d double, when date, absent int"
    read = csv.read_pipe_folder_quarantined(spark, str(folder), {
        "one.csv": schema, "two.csv": "s string, n string, d double, when string"})
    day = dt.date(2020, 1, 31)
    assert rows(read.tables["one.csv"]) == sorted([("x", 1, None, day, None), (None, None, None, None, None)], key=repr)
    assert read.tables["two.csv"].count() == 3 and read.tables["free.csv"].count() == 3
    assert rows(read.bad_rows) == sorted([(n, "ragged", csv.RAGGED) for n in ("one.csv", "two.csv", "free.csv")] + [
        ("one.csv", "y|z|1|2020-02-30", csv.UNTYPED)], key=repr)
    # finding bad rows reads marks of the copy and casts no cell again
    assert "cast(" not in _plan(read.bad_rows)
