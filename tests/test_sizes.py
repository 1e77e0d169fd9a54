"""Work that must grow with the rows, not with estimates or fixed numbers."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.operators import intervals, ordered
from millrace.plans import monitoring
from millrace.session import fresh_path, pin
from millrace.sources import series
from millrace.streaming import snapshots

NOON = dt.datetime(2024, 1, 1, 12)


def _parts_seen(monkeypatch):
    seen, sort = [], ordered.pin_sorted
    monkeypatch.setattr(ordered, "pin_sorted", lambda df, order, parts=None: seen.append(parts) or sort(df, order, parts))
    return seen


def _moments(spark, n):
    """One statement per second; stored, so that both sides of a join have sizes."""
    return spark.range(n).select(F.timestamp_add("SECOND", F.col("id"), dates.as_ntz(str(NOON))).alias("created"), F.col("id").alias("c"), F.uuid().alias("text"))


def test_drilldown_sorts_as_few_parts_as_its_rows_need(spark, monkeypatch):
    """The estimate of a join is the product of its sides: here some terabytes, of 20,000 rows."""
    counters = ["calls", "plans", "rows", "shared_blks_hit", "shared_blks_read", "temp_blks_written", "total_exec_time", "total_plan_time", "wal_bytes"]
    rows = pin(_moments(spark, 20_000))
    statements = rows.select("created", F.lit(1).alias("queryid"), F.col("text").alias("datname"), F.lit("r").alias("rolname"), *[F.col("c").alias(c) for c in counters])
    epochs = rows.select("created", F.concat("text", "text").alias("stats_reset"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen = _parts_seen(monkeypatch)
    monkeypatch.setattr(ordered, "PART_BYTES", 4 << 20)
    try:
        out = monitoring.query_drilldown(statements, epochs, NOON, NOON + dt.timedelta(days=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert seen == [max(2, spark.sparkContext.defaultParallelism)] and out.count() == 0


def test_live_deltas_sort_as_few_parts_as_a_batch_needs(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PART_BYTES", 4 << 20)
    seen = _parts_seen(monkeypatch)
    job = snapshots.LiveDeltas(spark, fresh_path(spark, "live"), "text string", "c")
    for batch in range(2):
        later = _moments(spark, 20_000).withColumns({"created": F.timestamp_add("DAY", F.lit(batch), "created"), "text": F.sha1(F.col("c").cast("string")),
                                                     "stats_reset": dates.as_ntz(str(NOON)), "c": F.col("c") + batch})
        job.on_batch(pin(later), batch)
    assert set(seen) == {max(2, spark.sparkContext.defaultParallelism)}
    assert job.read().where("delta = 1").count() == 20_000


def test_a_range_enters_a_join_in_few_bins(spark, monkeypatch):
    """With equal keys a range has at most three bins, and only at levels where the other side can meet it."""
    rows = []
    whole = intervals._bins
    monkeypatch.setattr(intervals, "_bins", lambda df, level: rows.append(whole(df, level)) or rows[-1])
    left = pin(spark.range(1000).select((F.col("id") % 50).alias("k"), (F.col("id") * 3).alias("lo"), (F.col("id") * 3 + 14).alias("hi")))
    right = pin(spark.range(1000).select((F.col("id") % 50).alias("k"), (F.col("id") * 3).alias("lo"), (F.col("id") * 3 + F.col("id") % 120).alias("hi")))
    bounds = (F.col("lo"), F.col("hi"))
    got = intervals.interval_join(left, right, bounds, bounds, on=[(F.col("k"), F.col("k"))])
    brute = left.alias("a").join(right.alias("b"), F.expr("a.k = b.k AND a.lo <= b.hi AND b.lo <= a.hi"))
    assert got.count() == got.distinct().count() == brute.count()
    assert sum(df.count() for df in rows) <= 8 * 1000


def test_a_grid_has_parts_by_its_cells(spark, monkeypatch):
    monkeypatch.setattr(series, "CELLS", 100)
    grid = series.device_grid(spark, NOON, NOON + dt.timedelta(hours=9), dt.timedelta(hours=1), 200)
    assert grid.rdd.getNumPartitions() == 20 and grid.distinct().count() == 2000


def test_two_rollups_move_the_lines_once(spark, monkeypatch):
    from registry import reports

    calls, whole = [], reports.rollup.sales_rollup
    monkeypatch.setattr(reports.rollup, "sales_rollup", lambda *args: calls.append(args) or whole(*args))
    merged = reports.version_merge(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1
    plain = reports._money(whole(*reports._sales_inputs(spark, "/root/testdata/sf0.001")))
    assert merged.count() == plain.count() and merged.exceptAll(plain).isEmpty()
