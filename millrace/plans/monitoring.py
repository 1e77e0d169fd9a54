"""Query statistics: snapshot ingest, trends, top queries, drill-down.

Counters only grow until the server restarts (``stats_reset`` changes), so all
reports work on differences inside one restart epoch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.functions import text as tx
from millrace.operators import merge, ordered
from millrace.session import path_exists, pin

BLOCK_BYTES = 8192  # fixed value: size of one storage block
QUERY_KEY = ["queryid", "datname", "rolname"]


def _ntz(moment: dt.datetime) -> Column:
    return dates.as_ntz(moment.isoformat(sep=" "))


# The counters of a statement, in the order of the statistics view.
COUNTERS = [
    "calls", "total_plan_time", "total_exec_time", "rows", "shared_blks_hit", "shared_blks_read", "shared_blks_dirtied", "shared_blks_written",
    "local_blks_hit", "local_blks_read", "local_blks_dirtied", "local_blks_written", "temp_blks_read", "temp_blks_written", "blk_read_time",
    "blk_write_time", "wal_records", "wal_fpi", "wal_bytes",
]


def cluster_snapshot(stats: DataFrame, created: Column, counters: list[str], log_position: Column, started: Column) -> DataFrame:
    """All statements added up to one row for the snapshot time, with the log position and the start of the server."""
    sums = stats.agg(*[F.sum(c).alias(c) for c in counters])
    return sums.select(created.alias("created"), *counters, log_position.alias("log_position"), started.alias("stats_reset"))


def ingest_snapshot(stats: DataFrame, roles: DataFrame, databases: DataFrame, root: str, taken: dt.datetime,
                    log_position: Column, started: Column, counters: list[str] = COUNTERS) -> None:
    """Write one snapshot to the tables ``queries``, ``snapshots`` and ``statements`` under ``root``, as one.

    Each snapshot owns the folder ``taken=...`` of every table, so writing it
    again replaces it. Its mark under ``committed`` is written last; ``committed``
    reads marked snapshots only, so one that was broken off is not seen. Query texts are stored once per (queryid, datname,
    rolname); a query known from another snapshot keeps its text. Role and
    database names come from their small catalogs.
    """
    spark, root = stats.sparkSession, root.rstrip("/")
    folder, created = f"taken={taken:%Y%m%dT%H%M%S%f}", _ntz(taken)
    named = pin(stats.join(roles, "userid").join(databases, "dbid"), "snapshot")
    texts = named.select(*QUERY_KEY, "query")
    if path_exists(spark, f"{root}/committed"):
        known = committed(spark, root, "queries", texts.schema.toDDL()).where(F.col("taken") != folder.removeprefix("taken="))
    else:
        known = texts.limit(0)
    for name, rows in (
        ("queries", merge.insert_ignore(known.select(texts.columns), texts, QUERY_KEY, ["query"])),
        ("snapshots", cluster_snapshot(named, created, counters, log_position, started)),
        ("statements", named.select(created.alias("created"), *QUERY_KEY, *counters)),
    ):
        rows.write.mode("overwrite").parquet(f"{root}/{name}/{folder}")
    spark.range(1).write.mode("overwrite").parquet(f"{root}/committed/{folder}")


def committed(spark: SparkSession, root: str, name: str, schema: str | None = None) -> DataFrame:
    """Rows of the table ``name`` from marked snapshots, with ``taken``; the marks prune its folders."""
    reader = spark.read.schema(f"{schema}, taken string") if schema else spark.read
    marks = spark.read.schema("id long, taken string").parquet(f"{root}/committed").select("taken")
    return reader.parquet(f"{root}/{name}").withColumn("taken", F.col("taken").cast("string")).join(marks, "taken", "left_semi")


def _deltas(df: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    """Differences to the row before of the same key, and the seconds between."""
    stamped = df.withColumn("_at", F.col("created"))
    lagged = ordered.with_previous(stamped, keys, "created", ["_at", *counters])
    changes = {f"delta_{c}": F.col(c) - F.col(f"prev_{c}") for c in counters}
    seconds = dates.epoch_seconds_between(F.col("created"), F.col("prev__at"))
    return lagged.withColumns({**changes, "delta_seconds": seconds})


def cluster_trend(snapshots: DataFrame, as_of: dt.datetime, back: dt.timedelta) -> DataFrame:
    """Rates per second between snapshots; the first row of an epoch stays, with NULLs."""
    window = snapshots.where(F.col("created") > _ntz(as_of - back))
    counters = ["rows", "total_plan_time", "total_exec_time", "calls", "wal_bytes"]
    d = _deltas(window, ["stats_reset"], counters)
    per_second = F.nullif(F.col("delta_seconds"), F.lit(0.0))
    return d.select(
        F.col("created").alias("time"), "delta_rows", (F.col("delta_calls") / per_second).alias("calls"),
        (F.col("delta_total_plan_time") / per_second / 1000).alias("plan_time"),
        (F.col("delta_total_exec_time") / per_second / 1000).alias("exec_time"),
        (F.col("delta_wal_bytes") / per_second).alias("wal_bytes"),
    )


def report_bounds(snapshots: DataFrame, as_of: dt.datetime, back: dt.timedelta):
    """First and last snapshot time of the newest epoch inside the window.

    With a single snapshot in the window the start falls back to the snapshot
    before it, because a difference needs two.
    """
    window = snapshots.where(F.col("created") > _ntz(as_of - back))
    newest = merge.latest_group(window, "stats_reset", "created").first()
    if newest is None:
        return None
    first, last = newest["first"], newest["last"]
    if first == last:
        earlier = snapshots.where(F.col("created") < _ntz(first)).agg(F.max("created").alias("m")).first()
        first = earlier["m"]
    return first, last


def top_queries(statements: DataFrame, snapshots: DataFrame, queries: DataFrame, as_of: dt.datetime,
                back: dt.timedelta, pattern: str = ".*", n: int = 100) -> DataFrame:
    """Most expensive queries of the window by growth of execution and planning time.

    The two bounds are plain values by the time the statements are planned, so
    the scan prunes on them.
    """
    bounds = report_bounds(snapshots, as_of, back)
    if bounds is None or bounds[0] is None:
        rows = statements.limit(0)
    else:
        rows = statements.where(F.col("created").between(_ntz(bounds[0]), _ntz(bounds[1])))

    def growth(c: str) -> Column:
        return (F.max(c) - F.min(c)).alias(f"delta_{c}")

    span = dates.epoch_seconds_between(F.max("created"), F.min("created")).alias("delta_seconds")
    counters = ["total_exec_time", "total_plan_time", "calls", "shared_blks_hit", "shared_blks_read"]
    d = rows.groupBy(*QUERY_KEY).agg(span, *[growth(c) for c in counters])
    busy = d.where("delta_calls > 1 AND delta_total_exec_time > 1")
    found = busy.join(queries.where(F.col("query").rlike(f"(?i){pattern}")), QUERY_KEY)
    cost = F.col("delta_total_exec_time") + F.col("delta_total_plan_time")
    top = found.orderBy(cost.desc_nulls_first(), *QUERY_KEY).limit(n)
    per_second = F.nullif(F.col("delta_seconds"), F.lit(0.0))
    return top.select(
        "rolname", "datname", F.col("queryid").cast("string").alias("queryid"),
        (F.col("delta_total_exec_time") / per_second / 1000).alias("exec"),
        (F.col("delta_total_plan_time") / per_second / 1000).alias("plan"),
        (F.col("delta_calls") / per_second).alias("calls"),
        (F.col("delta_shared_blks_hit") / per_second * BLOCK_BYTES).alias("cache_hit"),
        (F.col("delta_shared_blks_read") / per_second * BLOCK_BYTES).alias("cache_miss"), "query",
    )


def query_drilldown(statements: DataFrame, snapshots: DataFrame, start: dt.datetime, stop: dt.datetime,
                    queryid: int | None = None) -> DataFrame:
    """Rates per second and per call between the snapshots of each query.

    ``statements.created`` joins its snapshot for the restart epoch. Ratios of
    two integer counters drop the fraction, as integer division does.
    """
    inside = (F.col("created") > _ntz(start)) & (F.col("created") < _ntz(stop))
    rows = statements.where(inside)
    if queryid is not None:
        rows = rows.where(F.col("queryid") == queryid)
    epochs = snapshots.where(inside).select("created", "stats_reset")
    counters = ["calls", "plans", "rows", "shared_blks_hit", "shared_blks_read", "temp_blks_written",
                "total_exec_time", "total_plan_time", "wal_bytes"]
    d = _deltas(rows.join(epochs, "created"), [*QUERY_KEY, "stats_reset"], counters)
    d = d.where("delta_calls > 0")
    per_second = F.nullif(F.col("delta_seconds"), F.lit(0.0))

    def rate(c: str, scale: float = 1) -> Column:
        return F.col(f"delta_{c}") / per_second * scale

    def per(c: str, base: str = "calls") -> Column:
        return F.col(f"delta_{c}") / F.nullif(F.col(f"delta_{base}"), F.lit(0))

    def whole_per(c: str, scale: int = 1) -> Column:
        ratio = F.expr(f"delta_{c} div nullif(delta_calls, 0)")
        return ratio * scale

    return d.select(
        F.col("created").alias("time"), *QUERY_KEY, rate("calls").alias("calls"), rate("plans").alias("plans"),
        rate("total_exec_time", 0.001).alias("exec_time"), rate("total_plan_time", 0.001).alias("plan_time"),
        whole_per("rows").alias("rows_per_query"), rate("shared_blks_hit", BLOCK_BYTES).alias("cache_hit"),
        rate("shared_blks_read", BLOCK_BYTES).alias("cache_miss"),
        rate("temp_blks_written", BLOCK_BYTES).alias("temp_bytes"), rate("wal_bytes").alias("wal_bytes"),
        per("total_exec_time").alias("exec_time_per_query"),
        per("total_plan_time", "plans").alias("plan_time_per_plan"),
        whole_per("shared_blks_hit", BLOCK_BYTES).alias("cache_hit_per_query"),
        whole_per("shared_blks_read", BLOCK_BYTES).alias("cache_miss_per_query"),
        whole_per("temp_blks_written", BLOCK_BYTES).alias("temp_bytes_written_per_query"),
        per("wal_bytes").alias("wal_bytes_per_query"),
    )


def spill_offenders(stats: DataFrame, min_blocks: int = 1000, n: int = 10, preview: int = 60) -> DataFrame:
    """Queries that write the most temporary blocks per call."""
    per_call = F.expr("temp_blks_written div nullif(calls, 0)")
    rows = stats.where(F.col("temp_blks_written") > min_blocks).withColumn("temp_blks_per_call", per_call)
    top = rows.orderBy(F.col("temp_blks_per_call").desc_nulls_last(), "queryid").limit(n)
    return top.select(
        "queryid", "calls", F.round("mean_exec_time", 0).alias("mean_ms"), "temp_blks_per_call",
        tx.pretty_bytes(F.col("temp_blks_per_call") * BLOCK_BYTES).alias("temp_per_call"),
        F.left("query", F.lit(preview)).alias("query_preview"),
    )
