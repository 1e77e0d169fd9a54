"""Streaming queries: the tables arrive as file streams; results are read when the stream is drained."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import dates, docs
from millrace.session import fresh_path
from millrace.streaming import batches, keyed, queue, snapshots
from millrace.streaming.rollup import OrderRollup
from registry import query, table
from registry.reports import _SALES, SNAPSHOTS_SQL, _clock, _money, _sales_inputs, catalogs, dumps, snapshot_rows


def _stream(spark, d, name, max_files=None):
    # a pattern serves both a single file and a folder of files
    return batches.read_stream(spark, f"{d}/{name}.parque[t]", table(spark, d, name).schema, max_files)


def _drain(stream, on_batch):
    batches.run(stream, on_batch, fresh_path(stream.sparkSession, "checkpoint")).awaitTermination()


def _order_stream(spark, d):
    """Order messages; pending orders come with a bad id, low-priority finished ones are cut off."""
    good = docs.xml_envelope(F.array(docs.xml_row("OrderID", F.col("o_orderkey"))))
    bad = docs.xml_envelope(F.array(docs.xml_row("OrderID", F.lit("badorder"))))
    low = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    body = F.when(F.col("o_orderstatus") == "P", bad).when(low, F.lit("<data><row><OrderID>7")).otherwise(good)
    key = F.col("o_orderkey")
    return queue.order_messages(_stream(spark, d, "orders"), "o_orderkey", key, key, body)


def _drained_rollup(spark, d, mode):
    job = OrderRollup(spark, fresh_path(spark, "rollup"), lambda: _sales_inputs(spark, d), mode)
    _drain(_order_stream(spark, d), job.on_batch)
    return job


_GOOD = "o_orderstatus <> 'P' AND NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"
_GOOD_SALES = _SALES.replace("JOIN customer ON c_custkey = o_custkey", f"JOIN customer ON c_custkey = o_custkey WHERE {_GOOD}")


@query("stream_rollup", f"SELECT * FROM {_GOOD_SALES}")
def stream_rollup(spark, d):
    return _money(_drained_rollup(spark, d, "add").read())


@query("stream_rollup_recompute", f"SELECT * FROM {_GOOD_SALES}")
def stream_rollup_recompute(spark, d):
    return _money(_drained_rollup(spark, d, "recompute").read())


@query("stream_dead_letter", f"""
SELECT CASE WHEN o_orderstatus = 'P' THEN 245 ELSE -999 END AS errorCode, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS handles,
       'OrderRollupContract' AS service_contract_name, 1 AS attempts
FROM orders WHERE NOT ({_GOOD}) GROUP BY 1
""")
def stream_dead_letter(spark, d):
    log = _drained_rollup(spark, d, "recompute").errors()
    return log.groupBy("errorCode", "service_contract_name", "attempts").agg(
        F.count("*").alias("n"), F.sum(F.col("conversation_handle").cast("bigint")).alias("handles")
    ).select("errorCode", "n", "handles", "service_contract_name", "attempts")


@query("stream_fanout", """
SELECT o_custkey + i AS OrderID, count(*) AS n FROM orders, (VALUES (0), (1), (2)) v(i) GROUP BY 1
""")
def stream_fanout(spark, d):
    """Messages with three ids each, fanned out to one row per id."""
    path = fresh_path(spark, "fanout")
    rows = [docs.xml_row("OrderID", F.col("o_custkey") + i) for i in range(3)]
    key = F.col("o_orderkey")
    body = docs.xml_envelope(F.array(*rows))
    messages = queue.order_messages(_stream(spark, d, "orders"), "o_orderkey", key, key, body)

    def on_batch(df, batch_id):
        ids = queue.fan_out(queue.received(df))
        batches.write_batch(ids.groupBy("OrderID").agg(F.count("*").alias("n")), path, batch_id)

    _drain(messages, on_batch)
    parts = batches.read_batches(spark, path, "OrderID bigint, n bigint")
    return parts.groupBy("OrderID").agg(F.sum("n").alias("n"))


@query("stream_snapshot", """
SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS created, count(*) AS calls, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events
""")
def stream_snapshot(spark, d):
    path = fresh_path(spark, "snapshots")
    _drain(_stream(spark, d, "events"), snapshots.snapshot_batch(path, "ts", "value"))
    rows = batches.read_batches(spark, path, snapshots.SNAPSHOT_SCHEMA)
    summed = rows.agg(F.max("created").alias("created"), F.sum("calls").alias("calls"),
                      F.sum("total_value").cast("double").alias("total_value"))
    return _clock(summed, "created")


@query("stream_snapshot_counters", SNAPSHOTS_SQL)
def stream_snapshot_counters(spark, d):
    """Dumps of the statistics arrive one by one; each is stored with all counters."""
    files, root = fresh_path(spark, "dumps"), fresh_path(spark, "history")
    for moment, stats in dumps(spark, d):
        rows = stats.withColumn("taken", dates.as_ntz(moment.isoformat(sep=" ")))
        rows.write.mode("append").parquet(files)
    job = snapshots.snapshot_job(root, *catalogs(spark, d), F.lit(1000).cast("bigint"), dates.as_ntz("2024-01-01 00:00:00"))
    _drain(batches.read_stream(spark, files, rows.schema), job)
    return snapshot_rows(spark, root)


@query("stream_deltas", """
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created, event_id - lag(event_id) OVER w AS delta,
       round((epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6, 6) AS seconds
FROM events WINDOW w AS (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts)
""")
def stream_deltas(spark, d):
    """The event number as a growing counter per user, restarting every week; the rows arrive in three files."""
    files, root = fresh_path(spark, "counters"), fresh_path(spark, "deltas")
    rows = table(spark, d, "events").select(
        "user_id", F.col("ts").alias("created"), "event_id", F.date_trunc("week", "ts").cast("timestamp_ntz").alias("stats_reset"))
    rows.repartitionByRange(3, "created").write.parquet(files)
    job = snapshots.LiveDeltas(spark, root, "user_id bigint", "event_id")
    batches.run(batches.read_stream(spark, files, rows.schema, max_files=1), job.on_batch, fresh_path(spark, "checkpoint")).awaitTermination()
    return _clock(job.read().select("user_id", "created", "delta", F.round("seconds", 6).alias("seconds")), "created")


@query("stream_alerts", """
SELECT event_id AS session_id, TRUE AS email_sent, ts < TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 30 MINUTE AS email2_sent
FROM events WHERE ts < TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 5 MINUTE AND event_type <> 'signup'
""")
def stream_alerts(spark, d):
    active = _stream(spark, d, "events").select(
        F.col("event_id").alias("session_id"), F.concat(F.lit("u"), "user_id").alias("login_name"),
        F.col("event_type").alias("database_name"), F.col("props").alias("program_name"), F.col("ts").alias("start_time"),
    )
    schema = ("session_id bigint, login_name string, database_name string, program_name string, "
              "start_time timestamp_ntz")
    job = snapshots.AlertJob(spark, fresh_path(spark, "alerts"), schema, dates.as_ntz("2024-01-28 12:00:00"),
                             databases=["signup"])
    _drain(active, job.on_batch)
    return job.known().select("session_id", "email_sent", "email2_sent")


def _in_two_runs(spark, first, second, stream_of, columns):
    """Rows of a stream that is started, ends, and is started again on its checkpoint when more has come."""
    files, out, checkpoint = (fresh_path(spark, n) for n in ("arrivals", "told", "checkpoint"))
    for load in (first, second):
        load.write.mode("append").parquet(files)
        stream = stream_of(batches.read_stream(spark, files, first.schema))
        batches.run(stream, lambda df, batch_id: batches.write_batch(df, out, batch_id), checkpoint).awaitTermination()
    return batches.read_batches(spark, out, columns)


def _middle(spark, d):
    low, high = table(spark, d, "events").agg(F.min("ts"), F.max("ts")).first()
    return low + (high - low) // 2


@query("stream_session_alerts", """
WITH rows_in AS (
  SELECT user_id, date_trunc('day', ts) AS st, ts, lag(ts) OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts) AS before FROM events
), lives AS (
  SELECT *, lead(life) OVER (PARTITION BY user_id, st ORDER BY life) IS NOT NULL AS followed FROM (
    SELECT user_id, st, life, min(ts) AS f, max(ts) AS l FROM (
      SELECT *, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, st ORDER BY ts) AS life FROM rows_in)
    GROUP BY 1, 2, 3)
), due AS (
  SELECT user_id, st, l, followed, 'low' AS alert, greatest(f, st + INTERVAL 1 HOUR) AS told FROM lives
  UNION ALL SELECT user_id, st, l, followed, 'high', greatest(f, st + INTERVAL 12 HOUR) FROM lives
  UNION ALL SELECT user_id, st, l, followed, 'closed', l + INTERVAL 6 HOUR FROM lives
)
SELECT user_id AS session_id, strftime(st, '%Y-%m-%d') AS day, alert, strftime(told, '%Y-%m-%d %H:%M:%S.%f') AS told_at FROM due
WHERE told <= l + INTERVAL 6 HOUR
AND (followed OR told <= l AND alert <> 'closed' OR epoch_us(told) <= ((SELECT max(epoch_ms(ts)) FROM events) - 600000) * 1000)
""")
def stream_session_alerts(spark, d):
    """Every event shows the session of its user and day at work; alerts after 1 and 12 hours by rows or timers, closed after 6 silent hours."""
    rows = table(spark, d, "events").select(F.col("user_id").alias("session_id"), F.date_trunc("day", "ts").cast("timestamp").alias("start_time"),
                                            F.col("ts").cast("timestamp").alias("collection_time"))
    half = F.col("collection_time") < F.lit(_middle(spark, d)).cast("timestamp_ntz").cast("timestamp")
    hours = [dt.timedelta(hours=h) for h in (1, 12, 6)]
    told = _in_two_runs(spark, rows.where(half), rows.where(~half), lambda s: keyed.session_alerts(
        s, key=["session_id", "start_time"], low=hours[0], high=hours[1], silence=hours[2], late="10 minutes"),
        "session_id long, start_time timestamp, alert string, at timestamp")
    return _clock(told.select("session_id", F.date_format("start_time", "yyyy-MM-dd").alias("day"), "alert", F.col("at").alias("told_at")), "told_at")


_DELTAS = """
(SELECT user_id, ts, event_id AS counter, event_id - lag(event_id) OVER w AS delta, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6 AS seconds
 FROM events WINDOW w AS (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts))
"""
_PASSED = "((SELECT max(epoch_ms(ts)) FROM events) - 172800000) * 1000"


def _counters(spark, d):
    """The event number as a growing counter per user that starts over every week; some rows come a day late, some twice."""
    rows = table(spark, d, "events").select(
        "user_id", F.col("ts").cast("timestamp").alias("created"), F.date_trunc("week", "ts").cast("timestamp").alias("stats_reset"), "event_id")
    middle = _middle(spark, d)
    before, eve = (F.col("created") < F.lit(m).cast("timestamp_ntz").cast("timestamp") for m in (middle, middle - dt.timedelta(days=1)))
    late, twice = before & ~eve & (F.col("event_id") % 5 == 0), before & ~eve & (F.col("event_id") % 11 == 0)
    return rows.where(before & ~late), rows.where(~before | late | twice)


@query("stream_counter_deltas", f"""
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created, counter, delta, round(seconds, 6) AS seconds FROM {_DELTAS} WHERE epoch_us(ts) <= {_PASSED}
""")
def stream_counter_deltas(spark, d):
    told = _in_two_runs(spark, *_counters(spark, d), lambda s: keyed.counter_deltas(s, ["user_id"], "created", "stats_reset", "event_id", "2 days"),
                        "user_id long, created timestamp, counter long, delta long, seconds double")
    return _clock(told.select("user_id", "created", "counter", "delta", F.round("seconds", 6).alias("seconds")), "created")


@query("stream_minute_deltas", f"""
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S.%f') AS start, count(*) AS rows, CAST(sum(delta) AS BIGINT) AS delta, CAST(sum(CAST(round(seconds * 1e6) AS BIGINT)) AS BIGINT) AS micros
FROM {_DELTAS} GROUP BY 1 HAVING epoch_us(max(date_trunc('minute', ts))) + 60000000 <= {_PASSED}
""")
def stream_minute_deltas(spark, d):
    """Deltas of all users per minute."""
    told = _in_two_runs(spark, *_counters(spark, d), lambda s: keyed.per_window(
        keyed.counter_deltas(s, ["user_id"], "created", "stats_reset", "event_id", "2 days")), "start timestamp, rows long, delta long, seconds double")
    return _clock(told.select("start", "rows", "delta", F.round(F.col("seconds") * 1e6).cast("long").alias("micros")), "start")


@query("change_envelopes", """
SELECT DISTINCT l_orderkey AS OrderID FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05
AND (l_orderkey, l_quantity + 1, l_extendedprice, l_tax) NOT IN (SELECT (l_orderkey, l_quantity, l_extendedprice, l_tax) FROM lineitem)
""")
def change_envelopes(spark, d):
    """Changed orders packed into messages with many ids each, then read back by a consumer."""
    from registry.reports import changed_orders

    envelopes = queue.change_messages(changed_orders(spark, d))
    return queue.fan_out(queue.received(envelopes)).select("OrderID")


@query("dead_letter_replay", """
SELECT o_orderkey AS OrderID, 1 AS attempts FROM orders WHERE o_orderstatus = 'P'
""")
def dead_letter_replay(spark, d):
    """Messages with a bad id are repaired from their handle and sent again; unreadable ones are discarded."""
    dead = _drained_rollup(spark, d, "recompute").errors()
    kept = queue.discard(dead, dead.where(F.col("errorCode") == queue.UNREADABLE))
    repaired = docs.xml_envelope(F.array(docs.xml_row("OrderID", F.col("conversation_handle"))))
    again = queue.replay(kept).withColumn("message_body", repaired)
    ids = queue.fan_out(queue.received(again).withColumn("queuing_order", F.col("attempts")))
    return ids.select("OrderID", F.col("queuing_order").alias("attempts"))
