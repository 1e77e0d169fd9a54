"""Filters, joins, set operations, scalars, loads and table layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.plans import reports
from millrace.session import fresh_path
from millrace.sources import files, series, sinks, versions
from registry import query, table


@query("filter_mix", """
SELECT o_orderkey, 'order' AS kind, o_orderpriority FROM orders
WHERE o_orderstatus = 'F' OR o_totalprice > 300000 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_orderstatus NOT IN ('P') AND NOT regexp_matches(o_orderpriority, '(?i)LOW$')
""")
def filter_mix(spark, d):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    expensive = (F.col("o_totalprice") > 300000) & priority.isin("1-URGENT", "2-HIGH")
    kept = (status == "F") | expensive & ~status.isin("P") & ~priority.rlike("(?i)LOW$")
    return table(spark, d, "orders").where(kept).select("o_orderkey", F.lit("order").alias("kind"), "o_orderpriority")


@query("null_handling", """
SELECT event_id, coalesce(nullif(event_type, 'error'), 'none') AS kind,
       round(value / nullif(event_id % 4, 0), 6) AS share, nullif(event_type, 'error') IS NULL AS was_error
FROM events
""")
def null_handling(spark, d):
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    share = F.col("value") / F.nullif(F.col("event_id") % 4, F.lit(0).cast("bigint"))
    return table(spark, d, "events").select(
        "event_id", F.coalesce(kind, F.lit("none")).alias("kind"), F.round(share, 6).alias("share"),
        kind.isNull().alias("was_error"),
    )


@query("try_cast_route", """
SELECT TRY_CAST(body AS INTEGER) IS NULL AS dead, count(*) AS messages, CAST(sum(TRY_CAST(body AS INTEGER)) AS BIGINT) AS ids
FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'badorder' ELSE CAST(o_orderkey AS VARCHAR) END AS body FROM orders) GROUP BY 1
""")
def try_cast_route(spark, d):
    key = F.col("o_orderkey").cast("string")
    body = F.when(F.col("o_orderstatus") == "P", "badorder").otherwise(key)
    rows = table(spark, d, "orders").select(body.alias("body").try_cast("int").alias("id"))
    return rows.groupBy(F.col("id").isNull().alias("dead")).agg(F.count("*").alias("messages"), F.sum("id").alias("ids"))


@query("exists_guard", """
SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS big
FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""")
def exists_guard(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_totalprice")
    pending = orders.where("o_orderstatus = 'P'").select("c_custkey")
    big = orders.where("o_totalprice > 400000").select("c_custkey").distinct().withColumn("_big", F.lit(True))
    people = table(spark, d, "customer").select("c_custkey").join(pending, "c_custkey", "left_anti")
    joined = people.join(big, "c_custkey", "left")
    return joined.select("c_custkey", F.coalesce("_big", F.lit(False)).alias("big"))


@query("using_join", """
SELECT nationkey, n_name, c_name, s_count FROM
 (SELECT c_nationkey AS nationkey, c_name FROM customer) JOIN (SELECT n_nationkey AS nationkey, n_name FROM nation) USING (nationkey)
 JOIN (SELECT s_nationkey AS nationkey, count(*) AS s_count FROM supplier GROUP BY 1) USING (nationkey)
""")
def using_join(spark, d):
    people = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"), "c_name")
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    makers = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("s_count"))
    return people.join(nations, ["nationkey"]).join(makers, ["nationkey"])


@query("cross_grid", """
SELECT o_orderkey, a, b FROM orders, (SELECT unnest(generate_series(1, 5)) AS a), (SELECT unnest(generate_series(1, 2)) AS b)
""")
def cross_grid(spark, d):
    """Every order with every pair of two short series, expanded inside each row."""
    rows = table(spark, d, "orders").select("o_orderkey")
    with_a = series.expand_ints(rows, F.lit(1).cast("bigint"), F.lit(5).cast("bigint"), "a")
    return series.expand_ints(with_a, F.lit(1).cast("bigint"), F.lit(2).cast("bigint"), "b")


@query("apply_per_key", """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer, LATERAL (
  SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) >= 1996 AND year(o_orderdate) < 1998) o
""")
def apply_per_key(spark, d):
    start, stop = dates.as_ntz("1996-01-01 00:00:00"), dates.as_ntz("1998-01-01 00:00:00")
    wanted = table(spark, d, "orders").where(dates.half_open(F.col("o_orderdate"), start, stop))
    people = table(spark, d, "customer").select("c_custkey", "c_name")
    rows = wanted.join(people, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("cte_chain", """
WITH daily AS (SELECT o_orderdate AS day, count(*) AS n FROM orders GROUP BY 1),
weekly AS (SELECT date_trunc('week', day) AS week, max(n) AS busiest, CAST(sum(n) AS BIGINT) AS total FROM daily GROUP BY 1)
SELECT strftime(week, '%Y-%m-%d') AS week, busiest, total FROM weekly WHERE total > busiest
""")
def cte_chain(spark, d):
    daily = table(spark, d, "orders").groupBy(F.col("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    week = F.date_format(F.date_trunc("week", "day"), "yyyy-MM-dd").alias("week")
    weekly = daily.groupBy(week).agg(F.max("n").alias("busiest"), F.sum("n").alias("total"))
    return weekly.where("total > busiest")


@query("scalar_bounds", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders) OR o_totalprice = (SELECT max(o_totalprice) FROM orders)
""")
def scalar_bounds(spark, d):
    orders = table(spark, d, "orders")
    newest = orders.agg(F.max("o_orderdate")).scalar()
    dearest = orders.agg(F.max("o_totalprice")).scalar()
    kept = orders.where((F.col("o_orderdate") == newest) | (F.col("o_totalprice") == dearest))
    return kept.select("o_orderkey", "o_totalprice")


@query("union_rows", """
SELECT 'customer' AS kind, c_nationkey AS nationkey, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2
UNION ALL SELECT 'both', k, 0 FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)
""")
def union_rows(spark, d):
    buyers = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nationkey"))
    makers = table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nationkey"))
    counts = buyers.unionByName(makers).groupBy("kind", "nationkey").agg(F.count("*").alias("n"))
    both = counts.select("nationkey").distinct()
    return counts.unionByName(both.select(F.lit("both").alias("kind"), "nationkey", F.lit(0).cast("bigint").alias("n")))


@query("intersect_keys", """
SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
INTERSECT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'
""")
def intersect_keys(spark, d):
    rows = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")

    def of(flag):
        return rows.where(F.col("l_returnflag") == flag).drop("l_returnflag")

    return of("R").intersect(of("A"))


@query("date_parts", """
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(year(o_orderdate) AS INTEGER) AS y,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, strftime(o_orderdate, '%y-%m') AS ym,
       strftime(o_orderdate - INTERVAL 36 HOUR, '%Y-%m-%d %H:%M') AS earlier
FROM orders
""")
def date_parts(spark, d):
    ts = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", F.month(ts).alias("m"), F.year(ts).alias("y"), F.to_date(ts).cast("string").alias("d"),
        dates.year_month(ts).alias("ym"), F.date_format(dates.before(ts, 36 * 3600), "yyyy-MM-dd HH:mm").alias("earlier"),
    )


@query("epoch_diff", """
SELECT event_id, round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6, 6) AS seconds FROM events
""")
def epoch_diff(spark, d):
    seconds = dates.epoch_seconds_between(F.col("ts"), dates.as_ntz("2024-01-01 00:00:00"))
    return table(spark, d, "events").select("event_id", F.round(seconds, 6).alias("seconds"))


@query("rounding", """
SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(14,2)), 1) AS DOUBLE) AS one_digit,
       CAST(round(-CAST(o_totalprice AS DECIMAL(14,2)), 1) AS DOUBLE) AS negative, CAST(floor(-o_totalprice) AS BIGINT) AS floored,
       o_orderkey % 7 AS rest
FROM orders
""")
def rounding(spark, d):
    price = F.col("o_totalprice").cast("decimal(14,2)")
    return table(spark, d, "orders").select(
        "o_orderkey", F.round(price, 1).cast("double").alias("one_digit"),
        F.round(-price, 1).cast("double").alias("negative"), F.floor(-F.col("o_totalprice")).alias("floored"),
        (F.col("o_orderkey") % 7).alias("rest"),
    )


@query("scan_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def scan_sample(spark, d):
    return files.preview(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 20, ["o_orderkey"])


@query("row_count_stats", "SELECT count(*) AS row_count FROM lineitem")
def row_count_stats(spark, d):
    return files.row_count(spark, f"{d}/lineitem.parquet")


@query("inline_rows", """
SELECT o_orderkey, label FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) v(s, label) ON s = o_orderstatus
""")
def inline_rows(spark, d):
    names = files.inline_rows(spark, [("F", "finished"), ("O", "open"), ("P", "pending")], "o_orderstatus string, label string")
    return table(spark, d, "orders").join(F.broadcast(names), "o_orderstatus").select("o_orderkey", "label")


_LOADED = """
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM events GROUP BY 1
"""


def _loaded(df):
    total = F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total")
    return df.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), total)


@query("bulk_load_equal", _LOADED)
def bulk_load_equal(spark, d):
    """The table appended by event type, each append in small files."""
    path = fresh_path(spark, "bulk")
    events = table(spark, d, "events")
    sinks.bulk_append(events.where("event_type IN ('view', 'click')"), path, max_rows_per_file=10_000)
    sinks.bulk_append(events.where("event_type NOT IN ('view', 'click')"), path, max_rows_per_file=500)
    return _loaded(spark.read.parquet(path))


@query("reload", _LOADED)
def reload(spark, d):
    path = fresh_path(spark, "reloaded")
    events = table(spark, d, "events")
    sinks.reload(events.where("value > 100"), path)
    sinks.reload(events, path)
    return _loaded(spark.read.parquet(path))


# --- layout ------------------------------------------------------------------


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")


def _month_table(spark, d):
    path = fresh_path(spark, "orders-by-month")
    lo, hi = dt.datetime(1990, 1, 1), dt.datetime(2010, 1, 1)
    sinks.write_months(sinks.check_span(_orders(spark, d), "o_orderdate", lo, hi), path, "o_orderdate")
    return path


_MONTHS_SQL = """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids
FROM orders {where} GROUP BY 1
"""


def _months(df):
    return df.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("ids")
    )


@query("layout_month_write", _MONTHS_SQL.format(where=""))
def layout_month_write(spark, d):
    return _months(spark.read.parquet(_month_table(spark, d)))


@query("partition_pruned_avg", """
SELECT round(CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / count(*), 4) AS mean_amount
FROM orders WHERE o_orderdate > TIMESTAMP '2001-03-19'
""")
def partition_pruned_avg(spark, d):
    after = dt.datetime(2001, 3, 19)
    rows = sinks.read_span(spark, _month_table(spark, d), "o_orderdate", after=after)
    exact = rows.withColumn("amount", F.col("o_totalprice").cast("decimal(14,2)").cast("double"))
    mean = reports.mean_after(exact, "o_orderdate", "amount", after)
    return mean.select(F.round("mean_amount", 4).alias("mean_amount"))


@query("layout_retention", _MONTHS_SQL.format(where="WHERE o_orderdate >= TIMESTAMP '1998-06-01'"))
def layout_retention(spark, d):
    path = _month_table(spark, d)
    sinks.drop_months_before(spark, path, "1998-06")
    return _months(spark.read.parquet(path))


@query("layout_detach", _MONTHS_SQL.format(where="WHERE strftime(o_orderdate, '%Y-%m') <> '1999-02'"))
def layout_detach(spark, d):
    path = _month_table(spark, d)
    sinks.detach_month(spark, path, "1999-02", fresh_path(spark, "detached"))
    return _months(spark.read.parquet(path))


@query("layout_detach_attach", _MONTHS_SQL.format(where=""))
def layout_detach_attach(spark, d):
    path, side = _month_table(spark, d), fresh_path(spark, "detached")
    sinks.detach_month(spark, path, "1999-02", side)
    sinks.attach_month(spark, path, "1999-02", side, "o_orderdate")
    return _months(spark.read.parquet(path))


def _versioned_months(spark, d):
    orders = versions.VersionedTable(spark, fresh_path(spark, "orders-versions"), sinks.month_key("o_orderdate"))
    orders.reload(_orders(spark, d))
    return orders


@query("version_detach", _MONTHS_SQL.format(where="WHERE strftime(o_orderdate, '%Y-%m') NOT IN ('1999-02', '1999-03')"))
def version_detach(spark, d):
    """Two months are detached, one of them after it was attached again."""
    orders = _versioned_months(spark, d)
    orders.attach("1999-02", orders.detach("1999-02"))
    for month in ("1999-03", "1999-02"):
        orders.detach(month)
    return _months(orders.read())


@query("version_reload", _MONTHS_SQL.format(where="WHERE o_orderdate >= TIMESTAMP '1998-06-01'"))
def version_reload(spark, d):
    """Half of the rows, then all rows, then retention."""
    orders = versions.VersionedTable(spark, fresh_path(spark, "orders-versions"), sinks.month_key("o_orderdate"))
    orders.reload(_orders(spark, d).where("o_orderkey % 2 = 0"))
    orders.reload(_orders(spark, d))
    orders.drop_parts(lambda month: month < "1998-06")
    return _months(orders.read())


@query("layout_add_column", """
SELECT CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderstatus END AS status, count(*) AS n FROM orders GROUP BY 1
""")
def layout_add_column(spark, d):
    """Old rows written without a status, newer ones with it."""
    path = fresh_path(spark, "grown")
    orders = table(spark, d, "orders")
    cut = dates.as_ntz("2000-01-01 00:00:00")
    old = orders.where(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderdate")
    new = orders.where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("status"))
    sinks.write_months(old, path, "o_orderdate")
    sinks.write_months(new, path, "o_orderdate")
    return sinks.read_evolved(spark, path).groupBy("status").agg(F.count("*").alias("n"))


@query("layout_bucket20min", """
SELECT strftime(time_bucket(INTERVAL 20 MINUTE, ts, TIMESTAMP '1970-01-01'), '%Y%m%d-%H%M%S') AS part_start, count(*) AS n
FROM events GROUP BY 1
""")
def layout_bucket20min(spark, d):
    path = fresh_path(spark, "events-20min")
    sinks.write_time_buckets(table(spark, d, "events").select("event_id", "ts"), path, "ts", 20 * 60)
    counts = spark.read.parquet(path).groupBy("part_start").agg(F.count("*").alias("n"))
    return counts.select(F.date_format("part_start", "yyyyMMdd-HHmmss").alias("part_start"), "n")


@query("layout_time_chunks", """
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS part_week, count(*) AS n, count(DISTINCT user_id) AS users
FROM events GROUP BY 1
""")
def layout_time_chunks(spark, d):
    path = fresh_path(spark, "events-weekly")
    sinks.write_time_chunks(table(spark, d, "events"), path, "ts", ["user_id", "event_type"])
    weekly = spark.read.parquet(path).groupBy(F.col("part_week").cast("string").alias("part_week"))
    return weekly.agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
