"""Series, waves and sample rows derived from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import rand, sql, waves
from millrace.plans import sampledata
from millrace.sources import series
from registry import query, table

HOUR = dt.timedelta(hours=1)


@query("int_series", """
SELECT l_linenumber, count(*) AS n, CAST(sum(v) AS BIGINT) AS total
FROM (SELECT l_linenumber, unnest(generate_series(CAST(l_linenumber AS BIGINT), CAST(l_quantity AS BIGINT), 3)) AS v
      FROM lineitem)
GROUP BY l_linenumber
""")
def int_series(spark, d):
    lo, hi = F.col("l_linenumber").cast("bigint"), F.col("l_quantity").cast("bigint")
    rows = series.expand_ints(table(spark, d, "lineitem").select("l_linenumber", "l_quantity"), lo, hi, "v", 3)
    return rows.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@query("int_series_down", """
SELECT l_linenumber, count(*) AS n, CAST(sum(v) AS BIGINT) AS total
FROM (SELECT l_linenumber, unnest(generate_series(CAST(l_quantity AS BIGINT), CAST(l_linenumber AS BIGINT), -2)) AS v
      FROM lineitem)
GROUP BY l_linenumber
""")
def int_series_down(spark, d):
    lo, hi = F.col("l_linenumber").cast("bigint"), F.col("l_quantity").cast("bigint")
    rows = series.expand_ints(table(spark, d, "lineitem").select("l_linenumber", "l_quantity"), hi, lo, "v", -2)
    return rows.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@query("key_series", """
SELECT v, v % 2 = 0 AS even FROM (SELECT unnest(generate_series(
  (SELECT min(o_custkey) FROM orders), (SELECT max(o_custkey) FROM orders))) AS v)
""")
def key_series(spark, d):
    bounds = table(spark, d, "orders").agg(F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi")).first()
    return series.int_series(spark, bounds["lo"], bounds["hi"], name="v").withColumn("even", F.col("v") % 2 == 0)


@query("frac_series", """
SELECT p_size, count(*) AS n, CAST(sum(i * CAST(2.5 AS DECIMAL(4,1))) AS DOUBLE) AS total
FROM (SELECT p_size, unnest(generate_series(0, CAST(floor(p_size / 2.5) AS BIGINT))) AS i FROM part) GROUP BY p_size
""")
def frac_series(spark, d):
    rows = series.expand_fractions(
        table(spark, d, "part").select("p_size"), F.lit(0).cast("decimal(10,1)"),
        F.col("p_size").cast("decimal(10,1)"), "2.5", "v",
    )
    return rows.groupBy("p_size").agg(F.count("*").alias("n"), F.sum("v").cast("double").alias("total"))


def _order_times(spark, d, step):
    rows = table(spark, d, "orders").select("o_orderstatus", "o_orderdate")
    stop = F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate"))
    times = series.expand_times(rows, F.col("o_orderdate"), stop, step, "t")
    shown = F.date_format("t", "HH:mm").alias("clock")
    return times.groupBy("o_orderstatus", shown).agg(F.count("*").alias("n"))


def _order_times_sql(minutes):
    return f"""
SELECT o_orderstatus, strftime(t, '%H:%M') AS clock, count(*) AS n
FROM (SELECT o_orderstatus, unnest(generate_series(o_orderdate, o_orderdate + INTERVAL 1 DAY,
      INTERVAL {minutes} MINUTE)) AS t FROM orders)
GROUP BY 1, 2
"""


@query("ts_series", _order_times_sql(60))
def ts_series(spark, d):
    return _order_times(spark, d, HOUR)


@query("ts_series_85min", _order_times_sql(85))
def ts_series_85min(spark, d):
    return _order_times(spark, d, dt.timedelta(minutes=85))


def _event_bounds(spark, d):
    return table(spark, d, "events").agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.max("user_id").alias("devices")
    ).first()


_GRID = """
(SELECT t AS time, dev AS device_id
 FROM (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM events),
                                     (SELECT max(ts) FROM events), INTERVAL 1 HOUR)) AS t),
      (SELECT unnest(generate_series(1, (SELECT max(user_id) FROM events))) AS dev))
"""


def _grid(spark, d):
    bounds = _event_bounds(spark, d)
    start = bounds["lo"].replace(minute=0, second=0, microsecond=0)
    return series.device_grid(spark, start, bounds["hi"], HOUR, bounds["devices"])


@query("device_grid", f"""
SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS cells, CAST(sum(device_id) AS BIGINT) AS ids,
       count(DISTINCT device_id) AS devices, count(DISTINCT time) AS hours
FROM {_GRID} GROUP BY 1
""")
def device_grid(spark, d):
    # distinct devices as bits: what a task holds and sends does not grow with the cells
    bits = _grid(spark, d).groupBy("time", F.bitmap_bucket_number("device_id").alias("b")).agg(
        F.count("*").alias("cells"), F.sum("device_id").alias("ids"), F.bitmap_construct_agg(F.bitmap_bit_position("device_id")).alias("bits")
    )
    hourly = bits.groupBy("time").agg(F.sum("cells").alias("cells"), F.sum("ids").alias("ids"), F.sum(F.bitmap_count("bits")).alias("devices"))
    return hourly.groupBy(F.to_date("time").cast("string").alias("day")).agg(
        F.sum("cells").alias("cells"), F.sum("ids").alias("ids"), F.max("devices").alias("devices"),
        F.count("*").alias("hours"),
    )


@query("relative_series", """
SELECT user_id, count(*) AS n, strftime(min(t), '%Y-%m-%d %H:%M') AS first_time,
       strftime(max(t), '%Y-%m-%d %H:%M') AS last_time
FROM (SELECT user_id, unnest(generate_series(date_trunc('minute', last_seen) - INTERVAL 6 HOUR,
             date_trunc('minute', last_seen), INTERVAL 5 MINUTE)) AS t
      FROM (SELECT user_id, max(ts) AS last_seen FROM events GROUP BY user_id))
GROUP BY user_id
""")
def relative_series(spark, d):
    seen = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("as_of"))
    as_of = F.date_trunc("minute", "as_of").cast("timestamp_ntz")
    start = F.timestamp_add("HOUR", F.lit(-6), as_of)
    times = series.expand_times(seen, start, as_of, dt.timedelta(minutes=5), "t")
    shown = "yyyy-MM-dd HH:mm"
    return times.groupBy("user_id").agg(
        F.count("*").alias("n"), F.date_format(F.min("t"), shown).alias("first_time"),
        F.date_format(F.max("t"), shown).alias("last_time"),
    )


@query("cosine_wave", """
SELECT event_id, round(cos(event_id * 6.28 / 30), 6) AS unit_wave,
       round(10 * cos(event_id * 6.28 / 90), 6) AS tall_wave,
       round(50 + 10 * cos((event_id + 1) * 6.28 / 90), 6) AS shifted_wave
FROM events
""")
def cosine_wave(spark, d):
    rownum = F.col("event_id") + 1
    return table(spark, d, "events").select(
        "event_id",
        F.round(waves.cosine_wave(rownum, 30), 6).alias("unit_wave"),
        F.round(waves.cosine_wave(rownum, 90, amplitude=10), 6).alias("tall_wave"),
        F.round(waves.cosine_wave(rownum, 90, amplitude=10, offset=50, shift=0), 6).alias("shifted_wave"),
    )


@query("counter_reset", """
SELECT event_id, CASE WHEN (event_id + 1) % 10 = 0 THEN 10 ELSE (event_id + 1) % 10 END AS counter,
       round(value * (event_id + 1), 4) AS growing
FROM events
""")
def counter_reset(spark, d):
    rownum = F.col("event_id") + 1
    return table(spark, d, "events").select(
        "event_id", waves.counter_reset(rownum).alias("counter"),
        F.round(waves.growing(F.col("value"), rownum), 4).alias("growing"),
    )


@query("seasonal_traffic", """
WITH days AS (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
                     INTERVAL 1 DAY)) AS ts),
numbered AS (SELECT ts, row_number() OVER (ORDER BY ts) AS rownum FROM days),
daily AS (SELECT o_orderdate AS ts, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / 1000000 AS val
          FROM orders GROUP BY 1),
growth AS (SELECT * FROM (VALUES (1,1.04),(2,1.0),(3,1.0),(4,1.0),(5,1.0),(6,1.10),(7,1.0),(8,1.0),(9,1.0),(10,1.0),
           (11,1.08),(12,1.18)) g(m, p))
SELECT strftime(ts, '%Y-%m-%d') AS day, rownum,
       round((500 + 20 * val) * (1 + 0.2 * cos(rownum * 6.28 / 180)) * rownum * CAST(p AS DOUBLE), 2) AS value
FROM numbered JOIN daily USING (ts) JOIN growth ON m = month(ts)
""")
def seasonal_traffic(spark, d):
    orders = table(spark, d, "orders")
    bounds = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
    days = series.ts_series(spark, bounds["lo"], bounds["hi"], dt.timedelta(days=1), "ts", ordinal="rownum")
    amount = F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double") / 1_000_000
    daily = orders.groupBy(F.col("o_orderdate").alias("ts")).agg(amount.alias("val"))
    traffic = sampledata.seasonal_traffic(days.join(daily, "ts"))
    return traffic.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "rownum", F.round("value", 2).alias("value"))


_U = "(CAST('0x' || substr(md5(concat_ws('|', {keys})), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def _symbol(*keys):
    """SQL for symbol i (from 1) of a text: 16 bits of the hash of the keys and (i - 1) div 8."""
    bits = f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(keys)}, (i - 1) // 8)), CAST(1 + 4 * ((i - 1) % 8) AS INTEGER), 4) AS BIGINT)"
    return f"substr('{rand.SYMBOLS}', CAST(floor({bits} * {len(rand.SYMBOLS)} / 65536.0::DOUBLE) AS INTEGER) + 1, 1)"


def _u(*keys):
    return _U.format(keys=", ".join(["'7'", "o_orderkey", *keys]))


@query("sample_table", f"""
WITH drawn AS (
  SELECT o_orderkey, {_u("'cpu'")} AS u_cpu, {_u("'temperature'")} AS u_temp, {_u("'note'")} AS u_note,
         {_u("'location'")} AS u_loc, {_u("'location'", "'building'")} AS u_b, {_u("'location'", "'rack'")} AS u_r
  FROM orders),
sized AS (SELECT *, CAST(floor(u_note * 8 + 2) AS INTEGER) AS size, CAST(floor(u_loc * 19 + 1) AS INTEGER) AS gate FROM drawn)
SELECT o_orderkey, round(u_cpu * -97 + 100, 4) AS cpu, CAST(floor(u_temp * -55 + 83) AS BIGINT) AS temperature_c,
       CASE WHEN size >= 1 AND size % 5 > 1 THEN array_to_string(list_transform(generate_series(1, size), lambda i:
         {_symbol("'7'", "o_orderkey", "'note'")}), '') ELSE '' END AS note,
       CASE WHEN gate % 5 > 1 THEN '{{"building":' || CAST(floor(u_b * -19 + 20) AS BIGINT) || ',"rack":'
         || CAST(floor(u_r * -19 + 20) AS BIGINT) || '}}' END AS device_location
FROM sized
""")
def sample_table(spark, d):
    rows = table(spark, d, "orders", "o_orderkey")
    return sampledata.device_readings(rows, ["o_orderkey"], seed=7, portable=True)


@query("sample_drift", f"""
SELECT round(avg(round({_u("'cpu'")} * -97 + 100, 4)), 3) AS avg_cpu,
       round(avg(floor({_u("'temperature'")} * -55 + 83)), 3) AS avg_temp
FROM orders
""")
def sample_drift(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey")
    means = sampledata.drift(sampledata.device_readings(rows, ["o_orderkey"], seed=7, portable=True))
    return means.select(F.round("avg_cpu", 3).alias("avg_cpu"), F.round("avg_temp", 3).alias("avg_temp"))


_BULK_KEYS = ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]


def _bulk_u(*keys):
    return _U.format(keys=", ".join(["'3'", *_BULK_KEYS, *keys]))


def _bulk_text(label, hi):
    size = f"CAST(floor({_bulk_u(repr(label))} * {hi - 1} + 1) AS INTEGER)"
    symbol = f"CAST(floor({_bulk_u(repr(label), 'i')} * {len(rand.SYMBOLS)}) AS INTEGER) + 1"
    return f"array_to_string(list_transform(generate_series(1, {size}), lambda i: substr('{rand.SYMBOLS}', {symbol}, 1)), '')"


@query("sample_bulk_portable", f"""
SELECT {", ".join(_BULK_KEYS)}, CAST(floor({_bulk_u("1")} * -99 + 100) AS BIGINT) AS val1,
       CAST(floor({_bulk_u("2")} * -999 + 1000) AS BIGINT) AS val2, CAST(floor({_bulk_u("3")} * -9999 + 10000) AS BIGINT) AS val3,
       CAST(floor({_bulk_u("4")} * -99999 + 100000) AS BIGINT) AS val4, round({_bulk_u("5")} * -100 + 100, 2) AS val5,
       round({_bulk_u("6")} * -100 + 100, 5) AS val6, round({_bulk_u("7")} * -10000 + 10000, 7) AS val7,
       {_bulk_text("t8", 25)} AS val8, {_bulk_text("t9", 50)} AS val9
FROM lineitem
""")
def sample_bulk_portable(spark, d):
    """Load-test rows, one per line item, with the hash that the SQL check has as well."""
    return sampledata.bulk_rows(table(spark, d, "lineitem", *_BULK_KEYS), _BULK_KEYS, seed=3, portable=True)


def _grid_u(*keys):
    return _U.format(keys=", ".join(["'1'", "time", "device_id", *keys]))


@query("sample_grid", f"""
SELECT device_id, count(*) AS n, CAST(sum(CAST(round({_grid_u("'cpu'")} * -97 + 100, 4) AS DECIMAL(10,4))) AS DOUBLE) AS cpu_total,
       CAST(sum(floor({_grid_u("'temperature'")} * -55 + 83)) AS BIGINT) AS temperatures
FROM {_GRID} GROUP BY device_id
""")
def sample_grid(spark, d):
    """Readings over the whole event time grid, per device."""
    rows = sampledata.device_readings(_grid(spark, d), ["time", "device_id"], seed=1, portable=True)
    return rows.groupBy("device_id").agg(
        F.count("*").alias("n"), F.sum(F.col("cpu").cast("decimal(10,4)")).cast("double").alias("cpu_total"),
        F.sum("temperature_c").alias("temperatures"),
    )


def _u9(*keys):
    return _U.format(keys=", ".join(["'9'", "CAST(o_orderkey AS VARCHAR)", *keys]))


_SIZE9 = f"CAST(floor({_u9()} * 18 + 2) AS INTEGER)"


@query("sql_random_functions", f"""
SELECT o_orderkey, round({_u9()}, 9) AS u,
       CASE WHEN {_SIZE9} % 5 > 1 THEN array_to_string(list_transform(range(1, {_SIZE9} + 1),
            lambda i: {_symbol("'9'", "CAST(o_orderkey AS VARCHAR)")}), '') ELSE '' END AS note,
       CASE WHEN {_SIZE9} % 5 > 1 THEN '{{' || {" || ',' || ".join(f"""'"{k}":' || CAST(floor({_u9(f"'{k}'")} * -18 + 20) AS BIGINT)""" for k in "abc")} || '}}' END AS place
FROM orders
""")
def sql_random_functions(spark, d):
    """The random values as SQL functions; the DataFrame helpers give the same ones."""
    sql.register(spark)
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("k"))
    made = orders.selectExpr("o_orderkey", "k", "round(portable_uniform(9, k), 9) AS u", "random_text_between(9, k, 2, 20) AS note", "random_json(9, k, 2, 20) AS place")
    same = made.withColumn("helper", rand.random_text(9, F.col("k"), lo=2, hi=20, portable=True))
    checked = F.assert_true(F.col("note") == F.col("helper"), F.lit("SQL and DataFrame forms differ"))
    return same.select("o_orderkey", "u", F.when(checked.isNull(), F.col("note")).alias("note"), "place")


@query("sample_shared_note", f"""
SELECT o_orderkey, (SELECT string_agg({_symbol("'4'", "'shared'")}, '' ORDER BY i)
                    FROM range(1, 11) r(i)) AS note FROM orders
""")
def sample_shared_note(spark, d):
    """One generated text on all rows."""
    return sampledata.shared_note(table(spark, d, "orders").select("o_orderkey"), seed=4, portable=True)
