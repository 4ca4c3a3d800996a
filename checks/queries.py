"""Every registered query: name -> (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import LEGACY_CHECK, OPEN_YEARS_CHECK, PIVOT_YEARS, PORTAL_CHECK, WORKBOOK_CHECK, portal_tables, table
from tallyport.functions import dates, labels, text
from tallyport.operators import calendars, clean, metrics, paging, quality, reports, runlogs, search, user_sets
from tallyport.plans import bucketed, incremental, institution_statistics as plan
from tallyport.plans.workbook import TABLES
from tallyport.session import cut_lineage, scratch_path
from tallyport.sources import csv, files, queries as sql, snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Registers a query under its function name; dates leave as text, which compares everywhere."""
    def portable(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        return df.select(*[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz") else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ])

    QUERIES[run.__name__] = portable
    return run


def _usage(spark, sf_dir, profile=PORTAL_CHECK):
    return clean.usage(portal_tables(spark, sf_dir), profile)


def _lines(spark, sf_dir, profile=PORTAL_CHECK):
    return clean.usage_lines(portal_tables(spark, sf_dir), profile)


def _subscription(spark, sf_dir, profile=PORTAL_CHECK):
    return clean.subscription(portal_tables(spark, sf_dir), profile)


# --- Clean relations ---

@query
def usage_clean(spark, sf_dir):
    return clean.with_month_keys(_usage(spark, sf_dir))


@query
def subscription_clean(spark, sf_dir):
    return _subscription(spark, sf_dir)


@query
def usage_subscription(spark, sf_dir):
    usage = _usage(spark, sf_dir)
    # staged, so that their size is known; the log's own keys tell which ones need salt beyond a broadcast
    return clean.usage_subscription(usage, cut_lineage(_subscription(spark, sf_dir)), keys=usage)


@query
def usage_subscription_bucketed(spark, sf_dir):
    """Usage lines with subscriptions, joined from tables bucketed by user: no exchange at the join"""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    usage, subscriptions = bucketed.stage_for_user_joins(_usage(spark, sf_dir), _subscription(spark, sf_dir), parts)
    return bucketed.usage_subscription_bucketed(usage, subscriptions)


# --- Metrics ---

@query
def codes_per_institution_month(spark, sf_dir):
    found = metrics.codes_per_institution_month(_usage(spark, sf_dir))
    return metrics.sorted_nulls_last(found, ["institution_name", "year", "month"])


@query
def incremental_codes_month(spark, sf_dir):
    """Monthly codes kept by year: lines of the last year come in two parts, the second refresh computes that year only"""
    usage = _usage(spark, sf_dir)
    staged, out = scratch_path(spark, "usage_by_year"), scratch_path(spark, "codes_by_year")
    last = usage.agg(F.max("year")).first()[0]
    later = F.coalesce((F.col("year") == last) & (F.xxhash64(*usage.columns) % 2 == 0), F.lit(False))
    usage.where(~later).write.partitionBy("year").parquet(staged)
    incremental.refresh_by_year(spark, staged, metrics.codes_per_institution_month, out)
    usage.where(later).write.mode("append").partitionBy("year").parquet(staged)
    changed = incremental.refresh_by_year(spark, staged, metrics.codes_per_institution_month, out)
    if last is not None and changed != [str(last)]:
        raise AssertionError(f"the second refresh computed {changed}, not only {last}")
    found = incremental.read_by_year(spark, out, metrics.codes_per_institution_month(usage))
    return metrics.sorted_nulls_last(found, ["institution_name", "year", "month"])


@query
def users_rollup_bitmaps(spark, sf_dir):
    """Users per institution and month, year and all time, from bitmaps merged upwards: the log is grouped once"""
    return user_sets.user_rollup(_lines(spark, sf_dir))


@query
def codes_per_institution_month_open_years(spark, sf_dir):
    """Monthly codes under the profile without a year bound"""
    found = metrics.codes_per_institution_month(_usage(spark, sf_dir, OPEN_YEARS_CHECK))
    return metrics.sorted_nulls_last(found, ["institution_name", "year", "month"])


@query
def users_per_institution_month_legacy(spark, sf_dir):
    """Monthly users under the earlier rules: fewer excluded users, lines of unknown institutions stay"""
    return metrics.users_per_institution_month(_lines(spark, sf_dir, LEGACY_CHECK))


@query
def users_per_institution_month(spark, sf_dir):
    return metrics.users_per_institution_month(_lines(spark, sf_dir))


@query
def users_all_month(spark, sf_dir):
    return metrics.users_all_month(_lines(spark, sf_dir))


@query
def users_line_chart(spark, sf_dir):
    return reports.users_line_chart(metrics.users_all_month(_lines(spark, sf_dir)))


@query
def codes_per_institution_database_year(spark, sf_dir):
    return metrics.positive_codes(metrics.codes_per_institution_database_year(_usage(spark, sf_dir)))


@query
def institution_year_slice(spark, sf_dir):
    found = metrics.codes_per_institution_month(_usage(spark, sf_dir))
    return metrics.slice_metric(found, "Nation 3, North ", [1997, 1999])


@query
def active_years(spark, sf_dir):
    return metrics.active_years(_lines(spark, sf_dir))


@query
def active_years_per_institution(spark, sf_dir):
    return metrics.active_years_per_institution(_lines(spark, sf_dir))


@query
def subscribers_per_status(spark, sf_dir):
    return metrics.subscribers_per_status(_subscription(spark, sf_dir))


@query
def subscribers_per_create_year(spark, sf_dir):
    return metrics.subscribers_per_create_year(_subscription(spark, sf_dir))


@query
def subscribers_per_access_year(spark, sf_dir):
    return metrics.subscribers_per_access_year(_subscription(spark, sf_dir))


# --- Workbook ---

def _workbook(spark, sf_dir, metric):
    tables = portal_tables(spark, sf_dir)
    return metric(clean.usage(tables, WORKBOOK_CHECK), clean.subscription(tables, WORKBOOK_CHECK))


@query
def unique_users_month(spark, sf_dir):
    monthly = metrics.unique_users_month(_lines(spark, sf_dir, WORKBOOK_CHECK))
    return reports.calendar_order(reports.unique_users_periods(monthly))


@query
def codes_month(spark, sf_dir):
    return _workbook(spark, sf_dir, metrics.codes_month)


@query
def user_monthly_codes(spark, sf_dir):
    return _workbook(spark, sf_dir, metrics.user_monthly_codes)


@query
def institution_monthly_codes(spark, sf_dir):
    activity = reports.institution_activity(_workbook(spark, sf_dir, metrics.institution_monthly_codes))
    return reports.institution_activity_order(activity)


@query
def codes_month_by_year_pivot(spark, sf_dir):
    return metrics.month_by_year_pivot(_workbook(spark, sf_dir, metrics.codes_month), PIVOT_YEARS)


# --- Lookups ---

def _subscribed(spark, sf_dir, *columns):
    """Distinct ``columns`` of usage joined to subscriptions; shrunk before the join."""
    tables = portal_tables(spark, sf_dir)
    of_subscription = [c for c in columns if c in ("labo_name", "date_created", "date_last_access")]
    of_usage = [c for c in columns if c not in of_subscription]
    lines = clean.usage_lines(tables, PORTAL_CHECK).select("id_user", *of_usage).distinct()
    subscriptions = clean.subscription(tables, PORTAL_CHECK)
    kept = list(dict.fromkeys(["id_user", "labo_name", *of_subscription]))
    return clean.usage_subscription(lines, subscriptions.select(*kept).distinct())


@query
def databases_per_user(spark, sf_dir):
    found = metrics.databases_per_user(_subscribed(spark, sf_dir, "database_name2"))
    return found.select("id_user", F.array_join("databases", ", ").alias("databases"))


@query
def users_per_database(spark, sf_dir):
    rows = _subscribed(spark, sf_dir, "user_name", "database_name2")
    return metrics.users_per_database(rows, text.normalize_name("database_name2"))


@query
def users_per_institution(spark, sf_dir):
    rows = _subscribed(spark, sf_dir, "user_name", "labo_name")
    return metrics.users_per_institution(rows, text.normalize_name("labo_name"))


@query
def databases_per_institution(spark, sf_dir):
    rows = _subscribed(spark, sf_dir, "database_name2", "labo_name")
    return metrics.databases_per_institution(rows, text.normalize_name("labo_name"))


@query
def user_profile_dates(spark, sf_dir):
    found = metrics.user_profile_dates(_subscribed(spark, sf_dir, "date_created", "date_last_access"))
    return found.select("id_user", *[
        F.array_join(F.transform(c, lambda d: d.cast("string")), ", ").alias(c)
        for c in ("dates_created", "dates_last_access")
    ])


@query
def unknown_institutions(spark, sf_dir):
    """The log's own group names that are no subscribed institution as spelled"""
    requested = search.distinct_names(portal_tables(spark, sf_dir).usage_log, "group_name")
    known = _subscription(spark, sf_dir).select(F.col("labo_name").alias("institution_name"))
    return metrics.unknown_institutions(requested, known)


@query
def years_without_data(spark, sf_dir):
    """Years of shipments (one later than any order may have) without usage"""
    shipped = table(spark, sf_dir, "lineitem").select((F.year("l_shipdate") + 1).alias("year"))
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    return metrics.years_without_data(shipped.union(orders), _lines(spark, sf_dir))


# --- Search, report pages and charts ---

@query
def any_cell_search(spark, sf_dir):
    users = _subscribed(spark, sf_dir, "user_name", "database_name2", "labo_name")
    found = users.where(search.any_cell_contains(users.columns, [" NATION_1", "eSg "]))
    return search.keep_listed_columns(found, ["id_user", "user_name", "labo_name", "no_such_column"])


@query
def institution_theta_join(spark, sf_dir):
    names = search.distinct_names(portal_tables(spark, sf_dir).usage_log, "group_name")
    users = _subscribed(spark, sf_dir, "user_name", "labo_name").distinct()
    return search.contains_join(users, names)


def _written_reports(spark, sf_dir):
    """A folder with three report files, and their schemas. Years are doubles, as in a file whose
    years may be missing."""
    tables = portal_tables(spark, sf_dir)
    subscriptions = cut_lineage(clean.subscription(tables, PORTAL_CHECK))
    frames = {
        plan.USERS: clean.usage_subscription(_usage(spark, sf_dir), subscriptions, keys=_usage(spark, sf_dir)),
        plan.PER_STATUS: metrics.subscribers_per_status(subscriptions),
        plan.PER_CREATE_YEAR: metrics.subscribers_per_create_year(subscriptions).withColumn(
            "date_create_year", F.col("date_create_year").cast("double")
        ),
    }
    folder = scratch_path(spark, "input_csv")
    for name, frame in frames.items():
        csv.write_pipe_csv(frame, f"{folder}/{name}")
    return folder, {name: frame.schema for name, frame in frames.items()}


def _report_blocks(spark, sf_dir):
    names = search.distinct_names(portal_tables(spark, sf_dir).institution, "institution_name")
    files = csv.read_pipe_folder(spark, *_written_reports(spark, sf_dir))
    return reports.report_blocks(files, names)


@query
def institution_report_blocks(spark, sf_dir):
    return _report_blocks(spark, sf_dir)


@query
def report_pages(spark, sf_dir):
    pages = reports.report_pages(_report_blocks(spark, sf_dir))
    return pages.withColumn("lines", F.array_join("lines", "\n"))


# The files set aside by the quarantine key, and the rows of the ragged one that get a cell too many.
RAGGED_FILE = "stats_ragged.csv"
EMPTY_FILE = "stats_empty.csv"
HEADERLESS_FILE = "stats_headerless.csv"
RAGGED_EVERY = 3
_TO_CSV = {"sep": "|", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _quarantine_folder(spark, sf_dir):
    """The report folder with three more files: rows of one of them with a cell too many, one empty, one headerless."""
    folder, schemas = _written_reports(spark, sf_dir)
    # staged: a few rows, written to two files, each of which sorts them into ranges
    per_status = cut_lineage(metrics.subscribers_per_status(clean.subscription(portal_tables(spark, sf_dir), PORTAL_CHECK)))
    columns = per_status.columns
    line = F.to_csv(F.struct(*columns), _TO_CSV)
    extra = F.when(F.col("nb_subscribers") % RAGGED_EVERY == 0, F.concat(line, F.lit("|extra"))).otherwise(line)

    def write_lines(header, name):
        first = spark.createDataFrame([(header, 0)], "value string, k int")
        body = per_status.select(extra.alias("value"), F.lit(1).alias("k"))
        # one file, the header first: a sort, then the sorted ranges joined in order
        first.unionByName(body).orderBy("k").coalesce(1).select("value").write.text(f"{folder}/{name}")

    write_lines("|".join(columns), RAGGED_FILE)
    write_lines("", HEADERLESS_FILE)
    files.claim(spark, f"{folder}/{EMPTY_FILE}")
    return folder, schemas | {RAGGED_FILE: per_status.schema}


@query
def quarantined_report_pages(spark, sf_dir):
    """Report pages of a folder with bad rows and files: the good rows of all readable files are reported"""
    names = search.distinct_names(portal_tables(spark, sf_dir).institution, "institution_name")
    read = csv.read_pipe_folder_quarantined(spark, *_quarantine_folder(spark, sf_dir))
    pages = reports.report_pages(reports.report_blocks(read.tables, names))
    return pages.withColumn("lines", F.array_join("lines", "\n"))


@query
def report_quarantine(spark, sf_dir):
    """What the quarantining reader set aside: rows with their file and text, and whole files"""
    read = csv.read_pipe_folder_quarantined(spark, *_quarantine_folder(spark, sf_dir))
    return read.bad_rows.unionByName(read.bad_files.withColumn("line", F.lit(None).cast("string")))


@query
def folder_scan(spark, sf_dir):
    """Rows per file and header layout of a scanned report folder"""
    scanned, _ = csv.scan_pipe_folder(spark, _written_reports(spark, sf_dir)[0])
    return scanned.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("user_name").alias("n_user_names"),
        F.sum(F.col("nb_subscribers").cast("bigint")).alias("nb_subscribers"),
    )


@query
def bar_chart_frames(spark, sf_dir):
    # one shuffle of distinct lines feeds all three
    found = plan.usage_metrics(_usage(spark, sf_dir))
    return reports.bar_chart_frames(found.laboratory, found.user, found.database)


# --- Sources and sinks: written to a new folder, read back ---

@query
def sql_source(spark, sf_dir):
    return sql.run_query(
        spark,
        "SELECT o_orderpriority, CAST(year(o_orderdate) AS INT) AS year, count(*) AS n_orders "
        "FROM {orders} WHERE o_orderstatus = :status GROUP BY ALL",
        {"status": "F"},
        orders=table(spark, sf_dir, "orders"),
    )


@query
def csv_pipe_roundtrip(spark, sf_dir):
    path = scratch_path(spark, plan.PER_CREATE_YEAR)
    found = metrics.subscribers_per_create_year(_subscription(spark, sf_dir))
    csv.write_pipe_csv(found, path)
    return csv.read_pipe_csv(spark, path, found.schema)


@query
def csv_delimited_read(spark, sf_dir):
    folder = scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    for status in ("F", "O", "P"):
        csv.write_csv(orders.where(F.col("o_orderstatus") == status), f"{folder}/orders_{status}")
    return csv.read_csv_folder(spark, folder, "orders", "orders_[FO].csv", orders.schema)[1]


@query
def snapshot_read_through(spark, sf_dir):
    path = scratch_path(spark, "customer")
    customer = table(spark, sf_dir, "customer").withColumn("origin", F.lit("saved"))
    snapshots.load_table(spark, customer, path)
    # the saved rows are preferred over those of today
    return snapshots.load_table(spark, customer.withColumn("origin", F.lit("new")), path, use_saved=True)


# Texts that a CSV reader takes for missing cells, given to the documents by the rest of their id by 5.
_MISSING_LOOKING = ("NA", "null", "", "None")


@query
def typed_snapshot_texts(spark, sf_dir):
    """Texts that read as missing from a CSV (NA, null, empty, None) come back from a saved extract as they were"""
    path = scratch_path(spark, "labels")
    rest = F.col("doc_id") % 5
    label = F.when(rest == 0, _MISSING_LOOKING[0]).when(rest == 1, _MISSING_LOOKING[1]).when(
        rest == 2, _MISSING_LOOKING[2]).when(rest == 3, _MISSING_LOOKING[3]).otherwise(F.col("source"))
    docs = table(spark, sf_dir, "documents").select("doc_id", label.alias("label"), "lang")
    snapshots.load_table(spark, docs.withColumn("origin", F.lit("saved")), path)
    return snapshots.load_table(spark, docs.withColumn("origin", F.lit("new")), path, use_saved=True)


@query
def csv_text_roundtrip(spark, sf_dir):
    """All texts and pages, with their quotes, separators and line breaks, through both writers"""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text"))
    piped, commas = scratch_path(spark, "documents.csv"), scratch_path(spark, "pages.csv")
    csv.write_pipe_csv(documents, piped)
    csv.write_csv(pages, commas)
    return csv.read_pipe_csv(spark, piped, documents.schema).select(F.lit("document").alias("kind"), "*").unionByName(
        csv.read_csv(spark, commas, "pages", ",", pages.schema)[1].select(F.lit("page").alias("kind"), "*"))


@query
def delimited_inference(spark, sf_dir):
    """Orders through semicolons and tabs, read back without a schema"""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    found = None
    for sep in (";", "\t"):
        path = scratch_path(spark, "orders.csv")
        orders.write.options(sep=sep, header=True).csv(path)
        read = csv.read_csv(spark, path, "orders", sep)[1]
        read = read.select(F.lit(";" if sep == ";" else "tab").alias("sep"), "*", F.lit(", ".join(kind for _, kind in read.dtypes)).alias("kinds"))
        found = read if found is None else found.unionByName(read)
    return found


@query
def numbered_missing(spark, sf_dir):
    """Row numbers where blocks and order keys may be missing"""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderstatus")).alias("block"),
        F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey")).alias("customer"))
    return paging.numbered_rows(orders, ["block"], ["customer", "o_orderkey"])


@query
def one_institution(spark, sf_dir):
    """A profile that names its institution reads its lines only"""
    return _usage(spark, sf_dir, replace(PORTAL_CHECK, institution="NATION_7"))


@query
def text_search(spark, sf_dir):
    """Whole documents that contain a whole benchmark item"""
    names = table(spark, sf_dir, "benchmark").select(F.col("text").alias("institution_name"))
    return search.contains_join(table(spark, sf_dir, "documents").select("doc_id", "text"), names, ["text"]).select("doc_id", "institution")


@query
def table_refresh_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "stats_sum_of_codes")
    columns = TABLES["stats_sum_of_codes"]
    monthly = _workbook(spark, sf_dir, metrics.codes_month)
    snapshots.publish_table(monthly.where("year = 1996"), columns, path)
    snapshots.publish_table(monthly, columns, path)
    return snapshots.published_table(spark, path)


@query
def partitioned_by_institution(spark, sf_dir):
    path = scratch_path(spark, "institutions")
    snapshots.write_per_institution(metrics.codes_per_institution_database_year(_usage(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query
def latest_snapshot(spark, sf_dir):
    root = scratch_path(spark, "snapshots")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    for folder, stamp, rest in (
        ("raw_orders_2023-07-10", "2023-07-10-09-51-55", 0),
        ("raw_orders_2024-01-02", "2024-01-02-00-00-01", 1),
        ("raw_orders_2024-01-02", "2024-01-02-23-59-59", 2),
        ("other_2025-01-01", "2025-01-01-00-00-00", 3),
    ):
        orders.where(F.col("o_orderkey") % 4 == rest).write.parquet(f"{root}/{folder}/csv/data_{stamp}")
    return spark.read.parquet(snapshots.newest_snapshot(spark, root, "raw_orders_"))


@query
def versioned_write(spark, sf_dir):
    path = scratch_path(spark, "versions")
    status = metrics.subscribers_per_status(_subscription(spark, sf_dir))
    snapshots.write_version(status.where("statut = 'PhD'"), path, "subscribers")
    snapshots.write_version(status, path, "subscribers_other")
    label = snapshots.write_version(status, path, "subscribers")
    return snapshots.read_version(spark, path, label)


# --- Functions on columns ---

@query
def sanitized_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"),
        text.safe_path("url").alias("path"),
        text.safe_filename("url").alias("file"),
        text.strip_non_printable("html").alias("printable"),
    )
    documents = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
        text.safe_path("source").alias("path"),
        text.safe_filename("text").alias("file"),
        text.strip_non_printable("text").alias("printable"),
    )
    return pages.unionByName(documents)


@query
def relative_date_window(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", *[
        value.alias(name) for name, value in dates.relative_bounds(F.col("o_orderdate").cast("date")).items()
    ])


@query
def static_lookups(spark, sf_dir):
    """Requests per continent (customers take a country by nation key) and instrument"""
    countries = F.array(*[F.lit(c) for c in ("France", "Japan", "Chile", "Egypt", "Atlantis")])
    country = F.element_at(countries, (F.col("institution_id") % 5 + 1).cast("int"))
    instrument = F.regexp_extract("source_name", "actions|indices|fonds", 0)
    return portal_tables(spark, sf_dir).usage_log.select(
        labels.continent_of(country).alias("continent"),
        labels.instrument_code(instrument).alias("instrument_code"),
        labels.price_table(instrument).alias("price_table"),
    ).groupBy("continent", "instrument_code", "price_table").agg(F.count(F.lit(1)).alias("n_requests"))


@query
def set_inclusion(spark, sf_dir):
    """Is every priority of a customer's orders among the priorities of the customer's finished ones"""
    orders = table(spark, sf_dir, "orders")
    # a set of at most the five priorities
    sets = orders.groupBy("o_custkey").agg(
        F.collect_set("o_orderpriority").alias("every"),
        F.collect_set(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("finished"),
    )
    return sets.select(
        "o_custkey",
        text.is_included("every", "finished").alias("all_in_finished"),
        text.is_included("finished", "every").alias("finished_in_all"),
    )


@query
def business_calendar(spark, sf_dir):
    bounds = table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end")
    )
    return calendars.calendar(bounds)


# --- Data quality ---

@query
def schema_contract(spark, sf_dir):
    return quality.check_contract(table(spark, sf_dir, "events"), [
        ("event_id", "int"), ("ts", "timestamp"), ("event_type", "int"), ("user_id", "float"),
        ("value", "float"), ("props", "bool"), ("missing", "str"),
    ])


@query
def column_profile(spark, sf_dir):
    return quality.column_profile(table(spark, sf_dir, "orders"))


@query
def narrowed_load(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return quality.load_narrowed(part, scratch_path(spark, "part"), dt.date(2024, 2, 29))


# --- Run logs ---

def _logs(spark, sf_dir):
    """Logs written from the events, in order, and read back as text."""
    stamp = F.date_format("ts", "yyyyMMdd HH:mm:ss")
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    message = (
        F.when((F.col("event_type") == "error") & (F.col("user_id") % 7 > 2),
               F.concat(F.lit("ERROR: "), F.col("props")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("ERREUR "), F.col("props")))
        .otherwise(F.col("event_type"))
    )
    lines = table(spark, sf_dir, "events").select(
        F.concat(F.lit("job_"), (F.col("user_id") % 7).cast("string"), F.lit(".log")).alias("log_file"),
        F.concat(stamp, F.lit(" - portal -"), level, F.lit(" - "), message).alias("value"),
        "event_id",
    )
    path = scratch_path(spark, "logs")
    # ranges keep the order of events over the part files without one task per log
    (
        lines.repartitionByRange("log_file", "event_id").sortWithinPartitions("log_file", "event_id")
        .select("log_file", "value").write.partitionBy("log_file").text(path)
    )
    return runlogs.read_logs(spark, path)


@query
def log_error_digest(spark, sf_dir):
    return runlogs.error_digest(_logs(spark, sf_dir)).orderBy("log_file", "error")


@query
def log_status(spark, sf_dir):
    return runlogs.log_status(_logs(spark, sf_dir))


@query
def log_tail(spark, sf_dir):
    return runlogs.log_tail(_logs(spark, sf_dir))


@query
def log_last_lines(spark, sf_dir):
    return runlogs.last_lines(_logs(spark, sf_dir), 20)
