"""Report tables: what a chart or a page of a report shows, one row per bar, point or page."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.config import REPORT_COLUMNS
from tallyport.functions import dates, labels, text
from tallyport.operators.metrics import positive_codes
from tallyport.operators.paging import paged_rows
from tallyport.operators.search import Needles, contains_join, keep_listed_columns, prepare_names
from tallyport.session import cut_lineage


# --- Pages -------------------------------------------------------------------------------------

def _all_whole(column: str) -> Column:
    value = F.col(column)
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(2.0**63))
    return F.coalesce(F.bool_and(whole), F.lit(True))


def whole_doubles_to_bigint(df: DataFrame) -> DataFrame:
    """Double columns that hold whole numbers only become bigint, so 2022.0 reads 2022.

    All columns are tested in one pass.
    """
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    if not doubles:
        return df
    tests = df.agg(*[_all_whole(c).alias(c) for c in doubles]).first()
    return df.withColumns({c: F.col(c).cast("bigint") for c in doubles if tests[c]})


def _whole_doubles_as_text(matched: DataFrame, needles: Needles) -> DataFrame:
    """Double columns as text, without decimals where all values of an institution are whole."""
    doubles = [f.name for f in matched.schema.fields if f.dataType.typeName() == "double"]
    if not doubles:
        return matched
    matched = cut_lineage(matched)
    whole = {c: f"__whole_{i}" for i, c in enumerate(doubles)}
    # one row per institution
    tests = matched.groupBy("institution").agg(*[_all_whole(c).alias(whole[c]) for c in doubles])
    joined = matched.join(F.broadcast(tests) if needles.small else tests, "institution")
    return joined.withColumns({
        c: F.when(F.col(whole[c]), F.col(c).try_cast("bigint").cast("string")).otherwise(F.col(c).cast("string"))
        for c in doubles
    }).select(*matched.columns)


def report_blocks(
    files: Mapping[str, DataFrame],
    names: DataFrame,
    shown: Mapping[str, Sequence[str]] = REPORT_COLUMNS,
) -> DataFrame:
    """Lines of every file that mention an institution: (institution, file, columns, line).

    Rows are cut to the columns ``shown`` for their file and made distinct before the search, so a
    log with many lines per user shrinks to its users first.
    """
    if not files:
        raise ValueError("no files to report on")
    needles = prepare_names(names)
    blocks = []
    for file, rows in sorted(files.items()):
        cut = keep_listed_columns(rows, shown[file] if file in shown else rows.columns)
        kept = _whole_doubles_as_text(contains_join(cut, needles), needles)
        blocks.append(kept.select(
            "institution",
            F.lit(file).alias("file"),
            text.header_text(cut.columns).alias("columns"),
            text.row_text(cut.columns).alias("line"),
        ))
    return reduce(DataFrame.unionByName, blocks)


def report_pages(blocks: DataFrame, page_size: int = 10) -> DataFrame:
    """Text pages of ``report_blocks``: title ``name (i/n)``, file, columns and up to ten lines."""
    # written down first: the lines are few against the files they were found in, and sorting them
    # into ranges reads them twice
    paged = paged_rows(cut_lineage(blocks), ["institution", "file", "columns"], ["line"], page_size)
    # a page holds at most page_size lines
    pages = paged.groupBy("institution", "file", "columns", "page", "pages").agg(
        F.array_sort(F.collect_list(F.struct("row_no", "line"))).alias("rows")
    )
    return pages.select(
        "institution", "file", "page", "pages",
        F.concat(
            "institution", F.lit(" ("), F.col("page").cast("string"), F.lit("/"),
            F.col("pages").cast("string"), F.lit(")"),
        ).alias("title"),
        "columns",
        F.col("rows.line").alias("lines"),
    )


# --- Chart frames ------------------------------------------------------------------------------

def bar_chart_frames(
    codes_by_month: DataFrame,
    users_by_month: DataFrame,
    codes_by_database: DataFrame,
    positive_only: bool = True,
) -> DataFrame:
    """Bars of the three charts of every institution and year, with axis step and limit.

    ``position`` is the month number for charts by month, else NULL. With ``positive_only`` the
    codes charts leave out bars without volume.
    """
    if positive_only:
        codes_by_month, codes_by_database = map(positive_codes, (codes_by_month, codes_by_database))

    def bars(frame: DataFrame, chart: str, position: Column, x: str, y: str) -> DataFrame:
        return frame.select(
            F.lit(chart).alias("chart"), "institution_name", "year",
            position.cast("int").alias("position"), F.col(x).alias("x"),
            F.col(y).cast("bigint").alias("y"),
        )

    month, none = F.col("month"), F.lit(None)
    frames = (
        bars(codes_by_month, "codes_per_month", month, "month2", "nb_codes")
        .unionByName(bars(users_by_month, "users_per_month", month, "month2", "nb_users"))
        .unionByName(bars(codes_by_database, "codes_per_database", none, "database_name2", "nb_codes"))
    )
    # a chart has at most twelve months or as many bars as there are classes
    top = F.max("y").over(Window.partitionBy("chart", "institution_name", "year"))
    return frames.withColumn("top", top).select(
        "chart", "institution_name", "year", "position", "x", "y",
        dates.axis_step("top").alias("axis_step"),
        dates.axis_limit("top").alias("axis_limit"),
    )


def users_line_chart(users_by_month: DataFrame) -> DataFrame:
    """One series per year of users per month."""
    return users_by_month.select(
        F.col("year").alias("series"), F.col("month").alias("position"),
        F.col("month2").alias("x"), F.col("nb_users").alias("y"),
    )


def unique_users_periods(unique_users: DataFrame) -> DataFrame:
    """Unique users per period ``2023-January``, for display in calendar order."""
    return unique_users.select(
        "year", "month_full", "month2",
        labels.period_label("year", "month2").alias("period"), "nb_unique_users",
    )


def calendar_order(monthly: DataFrame) -> DataFrame:
    """By year and month number; ``month_full`` begins with the number."""
    return monthly.orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month_full"))


def institution_activity(monthly_codes: DataFrame) -> DataFrame:
    """Bars ``January - Institution`` per year; one bar per source, so labels repeat."""
    return monthly_codes.select(
        "year", "month2", "institution_name", "database_name",
        labels.month_institution_label("month2", "institution_name").alias("label"),
        "sum_of_codes",
    )


def institution_activity_order(activity: DataFrame) -> DataFrame:
    """By year, month name as text, and institution."""
    return activity.orderBy(*[
        F.asc_nulls_last(c) for c in ("year", "month2", "institution_name", "database_name")
    ])
