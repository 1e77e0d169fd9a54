import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.plans import sampledata
from millrace.session import fresh_path
from millrace.sources import files, series, sinks

DAY0 = dt.datetime(2024, 1, 1)


def values(df, name="value"):
    return [r[name] for r in df.orderBy(name).collect()]


def test_int_series(spark):
    assert values(series.int_series(spark, 1, 10)) == list(range(1, 11))
    assert values(series.int_series(spark, 5, 1)) == []
    assert values(series.int_series(spark, 5, 1, -2)) == [1, 3, 5]
    assert values(series.int_series(spark, 0, 9, 4)) == [0, 4, 8]
    with pytest.raises(ValueError):
        series.int_series(spark, 1, 2, 0)


def test_frac_series(spark):
    assert [str(v) for v in values(series.frac_series(spark, "0", "10", "2.5"))] == ["0.0", "2.5", "5.0", "7.5", "10.0"]


def test_ts_series(spark):
    hourly = series.ts_series(spark, DAY0, DAY0 + dt.timedelta(days=1), dt.timedelta(hours=1), ordinal="n")
    assert hourly.count() == 25
    assert hourly.agg(F.max("n")).first()[0] == 25
    odd = values(series.ts_series(spark, DAY0, DAY0 + dt.timedelta(days=1), dt.timedelta(minutes=85)), "time")
    assert len(odd) == 17 and odd[-1] == dt.datetime(2024, 1, 1, 22, 40)
    two_years = series.ts_series(spark, dt.datetime(2020, 1, 1), dt.datetime(2021, 12, 31), dt.timedelta(days=1))
    assert two_years.count() == 731
    assert series.back_from(spark, DAY0, dt.timedelta(hours=1), dt.timedelta(minutes=1)).count() == 61


def test_device_grid(spark, plan_of):
    grid = series.device_grid(spark, DAY0, DAY0 + dt.timedelta(hours=11), dt.timedelta(hours=1), 4)
    assert grid.count() == 48 == grid.distinct().count()
    assert grid.agg(F.min("device_id"), F.max("device_id")).first()[:] == (1, 4)
    bulk = series.device_grid(spark, DAY0, DAY0 + dt.timedelta(days=1), dt.timedelta(minutes=5), 3500)
    assert bulk.count() == 1_011_500
    assert "CartesianProduct" not in plan_of(bulk) and "NestedLoop" not in plan_of(bulk)


def test_row_series_guard(spark, as_rows):
    df = spark.createDataFrame([(1, 3), (5, 1)], "a bigint, b bigint")
    assert as_rows(series.expand_ints(df, F.col("a"), F.col("b"), "v"), "a", "v") == [(1, 1), (1, 2), (1, 3)]
    steps = series.expand_in_step(spark.range(1), {"a": F.sequence(F.lit(1), F.lit(2)), "b": F.sequence(F.lit(7), F.lit(9))})
    assert as_rows(steps, "a", "b") == [(1, 7), (2, 8), (None, 9)]


def test_sample_means_approach_the_middle(spark):
    grid = series.device_grid(spark, DAY0, DAY0 + dt.timedelta(days=2), dt.timedelta(minutes=1), 10)
    means = sampledata.drift(sampledata.device_readings(grid, ["time", "device_id"], seed=9)).first()
    assert abs(means["avg_cpu"] - 51.5) < 1 and abs(means["avg_temp"] - 55) < 1
    shared = sampledata.shared_note(grid, 4)
    assert shared.select("note").distinct().count() == 1 and len(shared.first()["note"]) == 10


def test_read_lines_keeps_file_order_over_splits(spark):
    path = fresh_path(spark, "lines")
    lines = [f"line {i}" if i % 10 else "" for i in range(5000)]
    spark.createDataFrame([(line,) for line in lines], "v string").coalesce(1).write.text(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        back = files.read_lines(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        got = [(r["id"], r["line"]) for r in back.orderBy("id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i + 1, line or None) for i, line in enumerate(lines)]


def test_bad_delimited_row_raises(spark):
    path = fresh_path(spark, "bad")
    spark.createDataFrame([("a;1.5",), ("b;x",)], "v string").write.text(path)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_delimited(spark, path, "k string, v decimal(3,1)", sep=";").collect()


@pytest.fixture
def payments(spark):
    rows = [(i, dt.datetime(2024, 1 + i % 5, 1 + i % 28)) for i in range(200)]
    return spark.createDataFrame(rows, "id bigint, paid timestamp_ntz")


def test_month_layout_prunes(spark, payments, plan_of):
    path = fresh_path(spark, "payments")
    sinks.write_months(payments, path, "paid")
    late = sinks.read_span(spark, path, "paid", after=dt.datetime(2024, 3, 19))
    assert late.count() == payments.where("paid > timestamp_ntz'2024-03-19'").count()
    filters = [line for line in plan_of(late).splitlines() if "PartitionFilters" in line]
    assert filters and "2024-03" in filters[0]
    span = sinks.read_span(spark, path, "paid", start=dt.datetime(2024, 2, 1), stop=dt.datetime(2024, 3, 1))
    assert span.count() == payments.where("month(paid) = 2").count()


def test_row_outside_the_partitions_is_an_error(payments):
    with pytest.raises(PySparkException):
        sinks.check_span(payments, "paid", dt.datetime(2024, 1, 1), dt.datetime(2024, 5, 1)).collect()


def test_retention_detach_attach(spark, payments):
    path, side = fresh_path(spark, "payments"), fresh_path(spark, "detached")
    sinks.write_months(payments, path, "paid")
    assert sinks.drop_months_before(spark, path, "2024-02") == ["2024-01"]
    sinks.detach_month(spark, path, "2024-02", side)
    assert spark.read.parquet(path).count() == 120
    with pytest.raises(ValueError):
        sinks.attach_month(spark, path, "2024-01", side, "paid")
    sinks.attach_month(spark, path, "2024-02", side, "paid")
    assert spark.read.parquet(path).count() == 160


def test_hot_month_is_written_whole(spark):
    path = fresh_path(spark, "hot")
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, F.lit("2024-01-05")).otherwise(
        F.lit("2024-02-05")).cast("timestamp_ntz").alias("paid"))
    sinks.write_months(rows, path, "paid")
    assert spark.read.parquet(path).count() == 20_000
