import datetime as dt

import pytest

from pyspark.sql import functions as F

from millrace.functions import dates, docs
from millrace.plans import monitoring, rollup
from millrace.session import fresh_path
from millrace.streaming import batches, keyed, queue, snapshots
from millrace.streaming.rollup import OrderRollup

GOOD = "<data><row><OrderID>7</OrderID></row><row><OrderID>8</OrderID></row></data>"
BAD = "<data><row><OrderID>badorder</OrderID></row></data>"


def messages(spark, bodies):
    rows = [(f"h{i}", queue.ORDER_MESSAGE, body, queue.ORDER_CONTRACT, i, 0) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, queue.MESSAGE_SCHEMA)


def shop(spark):
    lines = spark.createDataFrame([(7, 1, 2, 10), (7, 2, 1, 5), (8, 1, 4, 20), (9, 1, 1, 1)],
                                  "OrderID bigint, StockItemID bigint, Quantity int, Price int")
    lines = lines.withColumn("Price", F.col("Price").cast("decimal(12,2)")).withColumn("TaxRate", F.lit(10).cast("decimal(6,2)"))
    day = dt.datetime(2024, 3, 1)
    orders = spark.createDataFrame([(7, 100, day), (8, 100, day), (9, 100, day)],
                                   "OrderID bigint, CustomerID bigint, OrderDate timestamp_ntz")
    customers = spark.createDataFrame([(100,)], "CustomerID bigint")
    items = spark.createDataFrame([(1,), (2,)], "StockItemID bigint")
    return lines, orders, customers, items


def figures(df):
    return {r["StockItemID"]: (r["Quantity"], float(r["TotalItemSale"])) for r in df.collect()}


def stream_of(spark, path, schema=queue.MESSAGE_SCHEMA, max_files=None):
    return batches.read_stream(spark, path, schema, max_files)


def test_receive_fans_out_and_routes_errors(spark, as_rows):
    taken = queue.received(messages(spark, [GOOD, BAD, "<data><row><OrderID>7"]))
    assert as_rows(queue.fan_out(taken), "OrderID") == [(7,), (8,)]
    log = queue.errors(taken).orderBy("queuing_order").collect()
    assert [(r["conversation_handle"], r["errorCode"], r["attempts"]) for r in log] == [
        ("h1", queue.CONVERSION_FAILED, 1), ("h2", queue.UNREADABLE, 1)
    ]
    assert log[0]["errorDescription"].startswith("OrderIDMsg | " + BAD)


def test_foreign_messages_are_not_received(spark):
    other = messages(spark, [GOOD]).withColumn("message_type_name", F.lit("Other"))
    assert queue.received(other).isEmpty()


def test_dead_letter_handling(spark, as_rows):
    dead = queue.errors(queue.received(messages(spark, [BAD, BAD]))).withColumn(
        "attempts", F.when(F.col("queuing_order") == 0, 5).otherwise(F.col("attempts")))
    assert as_rows(queue.replay(dead), "conversation_handle") == [("h1",)]
    assert as_rows(queue.quarantined(dead), "conversation_handle") == [("h0",)]
    assert as_rows(queue.discard(dead, dead.where("queuing_order = 0")), "conversation_handle") == [("h1",)]
    assert [r["queuing_order"] for r in queue.inspect(dead).collect()] == [0, 1]
    again = queue.received(queue.replay(dead).withColumn("message_body", F.lit(GOOD)))
    assert as_rows(queue.fan_out(again), "OrderID") == [(7,), (8,)]


def test_change_messages_hold_every_id_once(spark, as_rows):
    changed = spark.createDataFrame([(i % 50,) for i in range(120)], "OrderID bigint")
    envelopes = queue.change_messages(changed, ids_per_message=10)
    assert envelopes.count() > 1
    ids = queue.fan_out(queue.received(envelopes.withColumn("conversation_handle", F.lit("x"))))
    assert as_rows(ids, "OrderID") == sorted([(i,) for i in range(50)], key=repr)


def test_rollup_stream_over_bounded_batches(spark):
    path = fresh_path(spark, "inbox")
    for body in (GOOD, BAD, "<data><row><OrderID>9</OrderID></row></data>"):
        messages(spark, [body]).coalesce(1).write.mode("append").parquet(path)
    for mode in ("add", "recompute"):
        job = OrderRollup(spark, fresh_path(spark, "rollup"), lambda: shop(spark), mode)
        query = batches.run(stream_of(spark, path, max_files=1), job.on_batch, fresh_path(spark, "cp"))
        query.awaitTermination()
        assert figures(job.read()) == {1: (7, 34.1), 2: (1, 5.5)}
        assert job.errors().count() == 1
    assert len(batches.batch_ids(spark, f"{job.root}/orders")) == 3


def test_replayed_batch_counts_once_and_compaction_keeps_totals(spark):
    job = OrderRollup(spark, fresh_path(spark, "rollup"), lambda: shop(spark))
    first, second = messages(spark, [GOOD]), messages(spark, ["<data><row><OrderID>9</OrderID></row></data>"])
    job.on_batch(first, 0)
    job.on_batch(first, 0)
    want = figures(rollup.sales_rollup(*[t.where("OrderID < 9") if "OrderID" in t.columns else t for t in shop(spark)]))
    assert figures(job.read()) == want
    job.on_batch(second, 1)
    total = figures(job.read())
    job.compact()
    assert figures(job.read()) == total == figures(rollup.sales_rollup(*shop(spark)))
    job.on_batch(second, 2)
    assert figures(job.read())[1][0] == total[1][0] + 1  # "add" counts an order that comes again


def test_recompute_mode_follows_updates(spark):
    lines, orders, customers, items = shop(spark)
    now = {"lines": lines}
    job = OrderRollup(spark, fresh_path(spark, "rollup"), lambda: (now["lines"], orders, customers, items), "recompute")
    job.on_batch(messages(spark, [GOOD]), 0)
    now["lines"] = lines.withColumn("Quantity", F.col("Quantity") + 1000)
    job.on_batch(messages(spark, [GOOD]), 1)
    assert figures(job.read())[1][0] == 2006


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1], [1, 1, 2, 0]])
def test_live_deltas_in_any_order(spark, order):
    """Late files, a replayed batch, counters beyond 2**53 and a NULL counter."""
    t0, high, parts = dt.datetime(2024, 1, 1), 2**60, [[], [], []]
    value = {(k, i): None if (k, i) == (2, 5) else high + i * i * k for k in (1, 2) for i in range(12)}
    for (k, i), v in value.items():
        parts[i // 4].append((k, t0 + dt.timedelta(minutes=i), t0 if i < 7 else t0 + dt.timedelta(minutes=7), v))
    schema = "k bigint, created timestamp_ntz, stats_reset timestamp_ntz, c bigint"
    job = snapshots.LiveDeltas(spark, fresh_path(spark, "deltas"), "k bigint", "c")
    for n, part in enumerate(order):
        job.on_batch(spark.createDataFrame(parts[part], schema), n - (len(order) > 3 and n > 0))
    got = {(r["k"], r["created"]): (r["delta"], r["seconds"]) for r in job.read().collect()}
    assert len(got) == 24
    for k, i in value:
        now, past = value[k, i], value.get((k, i - 1))
        want = (None, None) if i in (0, 7) else (None if None in (now, past) else now - past, 60.0)
        assert got[k, t0 + dt.timedelta(minutes=i)] == want, (k, i)


def test_snapshot_rows_per_batch(spark):
    path, out = fresh_path(spark, "events"), fresh_path(spark, "snapshots")
    for n in (3, 5):
        rows = spark.range(n).select(dates.as_ntz("2024-01-01 00:00:00").alias("ts"), F.col("id").cast("double").alias("v"))
        rows.coalesce(1).write.mode("append").parquet(path)
    stream = stream_of(spark, path, "ts timestamp_ntz, v double", max_files=1)
    batches.run(stream, snapshots.snapshot_batch(out, "ts", "v"), fresh_path(spark, "cp")).awaitTermination()
    rows = batches.read_batches(spark, out, snapshots.SNAPSHOT_SCHEMA)
    assert sorted(r["calls"] for r in rows.collect()) == [3, 5]


def test_alert_job_versions(spark, as_rows):
    now = dt.datetime(2024, 1, 1, 12)
    schema = "session_id int, login_name string, database_name string, program_name string, start_time timestamp_ntz"
    old = [(1, "u", "app", "p", now - dt.timedelta(minutes=40))]
    active = spark.createDataFrame(old + [(2, "u", "app", "p", now - dt.timedelta(minutes=10))], schema)
    job = snapshots.AlertJob(spark, fresh_path(spark, "alerts"), schema, F.lit(now).cast("timestamp_ntz"))
    job.on_batch(active, 0)
    first = as_rows(job.known(), "session_id", "email_sent", "email2_sent")
    assert first == [(1, True, True), (2, True, False)]
    job.on_batch(active, 0)
    job.on_batch(active, 1)
    assert as_rows(job.known(), "session_id", "email_sent", "email2_sent") == first


def test_envelope_needs_no_rows(spark):
    assert queue.order_messages(spark.range(0), "id", F.col("id"), F.col("id")).isEmpty()
    empty = docs.xml_envelope(F.array().cast("array<string>"))
    assert spark.range(1).select(empty.alias("x")).first()["x"] == "<data></data>"


# keyed state

SESSIONS = "session_id int, login_name string, database_name string, start_time timestamp_ntz, collection_time timestamp_ntz"
NOON = dt.datetime(2024, 1, 1, 12)


def told(spark, folders, rows, kind, stream_of):
    """Add rows, start the stream on its checkpoint, and return all that it has told so far."""
    files, out, checkpoint = folders
    if rows:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(files)
    stream = stream_of(stream_of_files(spark, files, kind))
    batches.run(stream, lambda df, batch_id: batches.write_batch(df, out, batch_id), checkpoint).awaitTermination()
    return spark.read.parquet(out)


def stream_of_files(spark, files, kind):
    return batches.read_stream(spark, files, kind, max_files=1)


def snapshot(minute, *sessions):
    return [(s, "u", "db", NOON, NOON + dt.timedelta(minutes=minute)) for s in sessions]


def test_alerts_by_timers_over_a_restart(spark):
    """Session 1 is seen before each threshold only: both alerts come from timers. Session 3 falls silent and is closed without the second."""
    folders = [fresh_path(spark, n) for n in ("sessions", "told", "cp")]
    silence = dt.timedelta(minutes=12)

    def run(rows):
        df = told(spark, folders, rows, SESSIONS, lambda s: keyed.session_alerts(s, silence=silence))
        return {(r.session_id, r.alert, (r["at"] - NOON).total_seconds() / 60) for r in df.collect()}

    assert run(snapshot(1, 1, 2, 3)) == set()
    assert run(snapshot(8, 2)) == {(2, "low", 5.0), (1, "low", 5.0), (3, "low", 5.0)}
    first = run(snapshot(12, 1) + snapshot(20, 1, 2) + snapshot(28, 2))
    assert first == {(2, "low", 5.0), (1, "low", 5.0), (3, "low", 5.0), (3, "closed", 13.0)}
    # nothing of session 1 comes any more; its second alert is due at 30 and fires when the watermark passes that
    second = run(snapshot(31.5, 9))
    assert second - first == {(1, "high", 30.0), (2, "high", 30.0), (9, "low", 31.5), (9, "high", 31.5)}
    # of one key, rows that say so close and open anew; a row older than the last one changes nothing
    third = run(snapshot(60, 9) + snapshot(59.5, 9))
    assert third - second == {(1, "closed", 32.0), (2, "closed", 40.0), (9, "closed", 43.5), (9, "low", 59.5), (9, "high", 59.5)}


def test_a_batch_of_alerts_reads_no_earlier_batch(spark, monkeypatch):
    folders = [fresh_path(spark, n) for n in ("sessions", "told", "cp")]
    monkeypatch.setattr(batches, "read_batches", lambda *a: pytest.fail("read back"))
    alerts = lambda s: keyed.session_alerts(s)
    told(spark, folders, snapshot(1, 1), SESSIONS, alerts)
    assert told(spark, folders, snapshot(3, 1) + snapshot(5.5, 1), SESSIONS, alerts).count() == 1


def test_sessions_of_a_bucket_share_one_state_and_timer(spark, monkeypatch):
    """Calls to the state store follow the buckets, not the sessions; NULL and text keys are kept apart."""
    monkeypatch.setattr(keyed, "BUCKETS", 1)
    schema = "session_id bigint, name string, start_time timestamp_ntz, collection_time timestamp_ntz"
    folders = [fresh_path(spark, n) for n in ("sessions", "told", "cp")]
    ask = lambda s: keyed.session_alerts(s, key=["session_id", "name"], silence=dt.timedelta(minutes=12))
    names = [(k, n) for k in (None, 2**60, 2**60 + 1) for n in ("a", "b", None)]
    rows = lambda m, some: [(*n, NOON, NOON + dt.timedelta(minutes=m)) for n in some]
    told(spark, folders, rows(1, names), schema, ask)
    told(spark, folders, rows(12, names[:4]), schema, ask)
    got = {(r.session_id, r.name, r.alert, (r["at"] - NOON).total_seconds() / 60) for r in told(spark, folders, rows(40, names[:1]), schema, ask).collect()}
    lows, ends = {(*n, "low", 5.0) for n in names}, {(*n, "closed", 24.0 if n in names[:4] else 13.0) for n in names}
    assert got == lows | ends | {(*names[0], "low", 40.0), (*names[0], "high", 40.0)}
    state = spark.read.format("statestore").option("stateVarName", "sessions").load(folders[2])
    assert state.count() == 1


COUNTERS = "k int, created timestamp_ntz, stats_reset timestamp_ntz, c bigint"


def test_counter_deltas_in_event_time(spark):
    """Rows in any order within the delay, rows sent twice, a reset, a NULL counter and numbers beyond 2**53."""
    folders = [fresh_path(spark, n) for n in ("counters", "told", "cp")]
    value = {(k, i): None if (k, i) == (2, 5) else 2**60 + i * i * k for k in (1, 2) for i in range(30)}
    row = {(k, i): (k, NOON + dt.timedelta(minutes=i), NOON + dt.timedelta(minutes=7 * (i >= 7)), v) for (k, i), v in value.items()}
    loads = [[(k, i) for k, i in row if i < 10 and i not in (4, 8)], [(1, 8), (1, 4), (2, 9), (2, 4), (2, 8), (1, 12), (1, 11), (2, 10)],
             [(k, i) for k, i in row if i >= 10], [(1, 29)]]
    for load in loads:
        df = told(spark, folders, [row[x] for x in load], COUNTERS, lambda s: keyed.counter_deltas(s, ["k"], "created", "stats_reset", "c", "10 minutes"))
    got = {(r.k, int((r.created - NOON).total_seconds() // 60)): (r.counter, r.delta, r.seconds) for r in df.collect()}
    assert df.count() == len(got) and got.keys() == {x for x in value if x[1] <= 19}
    for k, i in got:
        now, past = value[k, i], value.get((k, i - 1))
        want = (None, None) if i in (0, 7) else (None if None in (now, past) else now - past, 60.0)
        assert got[k, i] == (now, *want), (k, i)


def test_window_sums_of_deltas(spark):
    folders = [fresh_path(spark, n) for n in ("counters", "told", "cp")]
    rows = [(k, NOON + dt.timedelta(seconds=20 * i), NOON, 10 * i) for k in (1, 2) for i in range(30)]

    def sums(stream):
        return keyed.per_window(keyed.counter_deltas(stream, ["k"], "created", "stats_reset", "c", "1 minute"))

    told(spark, folders, rows[:20] + rows[30:50], COUNTERS, sums)
    df = told(spark, folders, rows[20:30] + rows[50:], COUNTERS, sums)
    got = {int((r.start - NOON).total_seconds() // 60): (r["rows"], r.delta, r.seconds) for r in df.collect()}
    assert got == {m: (6, 60 - 20 * (m == 0), 120.0 - 40 * (m == 0)) for m in range(8)}


# the timed job

def dump(spark, minute, n):
    counters = ", ".join(f"{c} bigint" for c in monitoring.COUNTERS)
    rows = [(q, 1, 1, f"select {q}", *[minute * 100 + q + k for k in range(len(monitoring.COUNTERS))], NOON + dt.timedelta(minutes=minute)) for q in range(n)]
    return spark.createDataFrame(rows, f"queryid bigint, userid int, dbid int, query string, {counters}, taken timestamp_ntz")


def test_snapshot_job_commits_three_tables_at_once(spark, monkeypatch):
    root = fresh_path(spark, "history")
    roles, bases = spark.createDataFrame([(1, "r")], "userid int, rolname string"), spark.createDataFrame([(1, "d")], "dbid int, datname string")
    job = snapshots.snapshot_job(root, roles, bases, F.lit(5).cast("bigint"), dates.as_ntz("2024-01-01 00:00:00"))
    job(dump(spark, 1, 3), 0)
    whole = monitoring.cluster_snapshot

    def lost(*args):
        raise RuntimeError("lost between the tables")

    with monkeypatch.context() as m:
        m.setattr(monitoring, "cluster_snapshot", lost)
        with pytest.raises(RuntimeError):
            job(dump(spark, 2, 5), 1)
    assert monitoring.cluster_snapshot is whole
    seen = {n: monitoring.committed(spark, root, n).count() for n in ("queries", "snapshots", "statements")}
    assert seen == {"queries": 3, "snapshots": 1, "statements": 3}
    for _ in range(2):  # the batch runs again, and once more after that
        job(dump(spark, 2, 5), 1)
    seen = {n: monitoring.committed(spark, root, n).count() for n in ("queries", "snapshots", "statements")}
    assert seen == {"queries": 5, "snapshots": 2, "statements": 8}
    last = monitoring.committed(spark, root, "snapshots").orderBy(F.desc("created")).first()
    assert [last[c] for c in monitoring.COUNTERS] == [5 * (200 + k) + 10 for k in range(len(monitoring.COUNTERS))]
