"""Metrics refreshed by year against a full computation."""

from pyspark.sql import functions as F

from tallyport.operators import metrics
from tallyport.plans import incremental
from tallyport.sources import files


def usage_rows(spark, years):
    rows = [(f"inst{i % 3}", f"user{i % 5}", y, 1 + i % 12, i % 4) for y in years for i in range(40)]
    return spark.createDataFrame(rows, "institution_name string, user_name string, year int, month int, nb_codes long")


def full(df):
    return sorted(map(tuple, metrics.users_per_institution_month(df).collect()))


def kept(spark, out, like):
    return sorted(map(tuple, incremental.read_by_year(spark, out, metrics.users_per_institution_month(like)).collect()))


def test_refresh_computes_changed_years_only(spark, tmp_path):
    source, out = str(tmp_path / "usage"), str(tmp_path / "metric")
    first = usage_rows(spark, [2020, 2021, 2022])
    first.write.partitionBy("year").parquet(source)
    assert incremental.refresh_by_year(spark, source, metrics.users_per_institution_month, out) == ["2020", "2021", "2022"]
    assert incremental.refresh_by_year(spark, source, metrics.users_per_institution_month, out) == []
    more = spark.createDataFrame([("inst9", "new user", 2021, 3, 7)], first.schema)
    more.write.mode("append").partitionBy("year").parquet(source)
    assert incremental.refresh_by_year(spark, source, metrics.users_per_institution_month, out) == ["2021"]
    assert kept(spark, out, first) == full(first.unionByName(more))


def test_refresh_drops_years_whose_files_are_gone(spark, tmp_path):
    source, out = str(tmp_path / "usage"), str(tmp_path / "metric")
    rows = usage_rows(spark, [2020, 2021])
    rows.write.partitionBy("year").parquet(source)
    incremental.refresh_by_year(spark, source, metrics.users_per_institution_month, out)
    files.delete(spark, f"{source}/year=2020")
    assert incremental.refresh_by_year(spark, source, metrics.users_per_institution_month, out) == ["2020"]
    assert kept(spark, out, rows) == full(rows.where("year = 2021"))


def test_changed_year_is_read_alone(spark, tmp_path):
    source = str(tmp_path / "usage")
    usage_rows(spark, [2020, 2021, 2022]).write.partitionBy("year").parquet(source)
    read = spark.read.parquet(source).where(F.col("year").cast("string").isin(["2021"]))
    opened = [r[0] for r in read.select(F.input_file_name()).distinct().collect()]
    assert opened and all("year=2021" in f for f in opened)
    assert "PartitionFilters: [" in read._jdf.queryExecution().executedPlan().toString()
