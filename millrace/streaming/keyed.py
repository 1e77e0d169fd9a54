"""Stream operators that keep what they know per key in the state store, with timers.

A batch reads no earlier batch and touches only the keys (of sessions: groups of
keys) that it brings or whose timer ends. Both operators are streaming DataFrames: the state is part of the
checkpoint of the query that writes them.
"""

from __future__ import annotations

import datetime as dt
import pickle
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from millrace.plans import alerts

# the process that starts a stateful operator does not search the paths of the session, so the code travels with it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Groups of sessions that share a state; fixed, because the state of a stream is stored under them.
BUCKETS = 4096
_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs a store that keeps state on disk and writes changes only."""
    if spark.conf.get(_STORE_CONF, None) != STATE_STORE:
        spark.conf.set(_STORE_CONF, STATE_STORE)


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp"))


def _timer(micros: int) -> int:
    """Timers are milliseconds; none ends before its moment."""
    return -(-micros // 1000)


class SessionAlerts(StatefulProcessor):
    """Lives of sessions: low alert, high alert, closed.

    An alert is due when the session is older than its threshold, whether a new
    snapshot says so or a timer ends; at the time it is due, or when the session
    is first seen if that is later. A session without a snapshot for the time of
    silence has ended: it is closed and forgotten. A later snapshot of it begins
    anew. Rows of a batch are taken in time order; one that is older than the
    last row of its session changes nothing. All times are microseconds.

    A state holds the open sessions of one of ``BUCKETS``, with one timer for the
    first thing that is due among them: every call to the state store costs as
    much as the work on dozens of sessions.
    """

    def __init__(self, key: list[str], low: int, high: int, silence: int):
        self.key, self.silence, self.levels = key, silence, (("low", low), ("high", high))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", "open binary, timer long")

    def _due(self, session: tuple) -> list[tuple[int, int, str]]:
        """What is still to happen if no further row comes, in order."""
        start, first, last, told = session
        done = 0 if not told else 1 if told == "low" else 2
        end = last + self.silence
        out = [(max(first, start + age), rank, name) for rank, (name, age) in enumerate(self.levels) if rank >= done]
        return [x for x in sorted(out) if x[0] <= end] + [(end, len(self.levels), "closed")]

    def _until(self, session: tuple | None, now: int, strictly: bool) -> tuple[tuple | None, list[tuple[str, int]]]:
        told = []
        if session is not None:
            for at, _, name in self._due(session):
                if at > now or (name == "closed" and strictly and at == now):
                    break
                told.append((name, at))
                session = None if name == "closed" else (*session[:3], name)
        return session, told

    def _load(self) -> tuple[dict, int | None]:
        """Open sessions by key, each with the time of what is due first behind it; and the timer."""
        found = self.state.get()
        return ({}, None) if found is None else (pickle.loads(bytes(found[0])), found[1])

    def _set(self, open_: dict, key: tuple, session: tuple | None) -> None:
        if session is None:
            open_.pop(key, None)
        else:
            open_[key] = (session, self._due(session)[0][0])

    def _save(self, open_: dict, timer: int | None, ended: int | None = None) -> None:
        """Store the open sessions and move the timer from ``timer``, unless that one has just ended."""
        wanted = _timer(min(at for _, at in open_.values())) if open_ else None
        if wanted != timer or timer == ended:
            if timer is not None and timer != ended:
                self.handle.deleteTimer(timer)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        if open_:
            self.state.update((pickle.dumps(open_), wanted))
        else:
            self.state.clear()

    def _rows(self, key: tuple, told: list[tuple[str, int]]) -> Iterator[Row]:
        for name, at in told:
            yield Row(**dict(zip(self.key, key)), alert=name, at=at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        open_, timer = self._load()
        fresh: dict[tuple, list[tuple[int, int]]] = {}
        for row in rows:
            fresh.setdefault(tuple(row[k] for k in self.key), []).append((row["_seen"], row["_start"]))
        for name, seen in fresh.items():
            session, told = open_.get(name, (None, 0))[0], []
            for now, start in sorted(seen, key=lambda s: s[0]):
                session, due = self._until(session, now, strictly=True)
                told += due
                session = (start, now, now, "") if session is None else (*session[:2], max(session[2], now), session[3])
                session, due = self._until(session, now, strictly=True)
                told += due
            self._set(open_, name, session)
            yield from self._rows(name, told)
        self._save(open_, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        open_, timer = self._load()
        # all that the watermark has passed: a timer set now for such a moment would wait for the next batch
        now = 1000 * timerValues.getCurrentWatermarkInMs()
        for name in [name for name, (_, at) in open_.items() if at <= now]:
            session, told = self._until(open_[name][0], now, strictly=False)
            self._set(open_, name, session)
            yield from self._rows(name, told)
        self._save(open_, timer, ended=expiredTimerInfo.getExpiryTimeInMs())


def session_alerts(snapshots: DataFrame, seen: str = "collection_time", start: str = "start_time", key: list[str] = alerts.KEY,
                   low: dt.timedelta = dt.timedelta(minutes=alerts.LOW_MINUTES), high: dt.timedelta = dt.timedelta(minutes=alerts.HIGH_MINUTES),
                   silence: dt.timedelta = dt.timedelta(minutes=3), late: str = "1 minute") -> DataFrame:
    """Stream of (key, alert, at) from a stream of snapshots of active sessions.

    ``seen`` and ``start`` are timestamps in UTC sessions; rows later than
    ``late`` behind the newest one are not taken.
    """
    use_state_store(snapshots.sparkSession)
    moments = [k for k in key if snapshots.schema[k].dataType.typeName().startswith("timestamp")]
    marked = snapshots.withColumn("_at", F.col(seen).cast("timestamp")).withWatermark("_at", late)
    rows = marked.select("_at", *[_micros(k).alias(k) if k in moments else k for k in key], _micros(start).alias("_start"), _micros(seen).alias("_seen"))
    out = StructType([*[rows.schema[k] for k in key], StructField("alert", StringType()), StructField("at", LongType())])
    each = [int(span / dt.timedelta(microseconds=1)) for span in (low, high, silence)]
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int"))
    told = placed.groupBy("_bucket").transformWithState(SessionAlerts(key, *each), out, "append", "eventTime")
    return told.withColumns({k: F.timestamp_micros(k).cast(snapshots.schema[k].dataType if k in moments else "timestamp") for k in [*moments, "at"]})


class CounterDeltas(StatefulProcessor):
    """Differences of one growing counter to its row before, in time order.

    Rows wait in a list until the watermark passes them, so those that arrive in
    any other order within its delay are put right. A time that was told before,
    or waits already, is the same row sent again.
    """

    def __init__(self, key: list[str]):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kind = "created long, stats_reset long, counter long"
        self.waiting, self.last = handle.getListState("waiting", kind), handle.getValueState("last", kind)

    def _wake(self, first: int) -> None:
        timers = list(self.handle.listTimers())
        if not timers or _timer(first) < min(timers):
            for timer in timers:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(_timer(first))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = [(row["_created"], row["_reset"], row["_counter"]) for row in rows]
        self.waiting.appendList(fresh)
        self._wake(min(row[0] for row in fresh))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = 1000 * timerValues.getCurrentWatermarkInMs()
        rows = sorted({row[0]: tuple(row) for row in self.waiting.get()}.items())
        later = [row for created, row in rows if created > upto]
        last = tuple(self.last.get()) if self.last.exists() else None
        for created, row in rows[: len(rows) - len(later)]:
            if last is not None and created <= last[0]:
                continue
            same = last is not None and row[1] is not None and row[1] == last[1]
            grown = same and row[2] is not None and last[2] is not None
            moment = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=created)
            yield Row(**dict(zip(self.key, key)), created=moment, counter=row[2], delta=row[2] - last[2] if grown else None,
                      seconds=(created - last[0]) / 1e6 if same else None)
            last = row
        if last is not None:
            self.last.update(last)
        if later:
            self.waiting.put(later)
            self._wake(later[0][0])
        else:
            self.waiting.clear()


def counter_deltas(rows: DataFrame, key: list[str], created: str, stats_reset: str, counter: str, late: str) -> DataFrame:
    """Stream of (key, created, counter, delta, seconds) from a stream of counters, as the watermark (``late`` behind the newest row) passes them.

    ``delta`` and ``seconds`` are null on the first row of a key, after a
    changed ``stats_reset``, and ``delta`` where a counter is null. Later rows are
    not taken. ``created`` is the event time of the result.
    """
    use_state_store(rows.sparkSession)
    marked = rows.withColumn("_at", F.col(created).cast("timestamp")).withWatermark("_at", late).where(F.col("_at").isNotNull())
    plain = marked.select("_at", *key, _micros(created).alias("_created"), _micros(stats_reset).alias("_reset"), F.col(counter).cast("long").alias("_counter"))
    out = StructType([*[plain.schema[k] for k in key], StructField("created", TimestampType()), StructField("counter", LongType()),
                      StructField("delta", LongType()), StructField("seconds", DoubleType())])
    return plain.groupBy(*key).transformWithState(CounterDeltas(key), out, "append", "eventTime", eventTimeColumnName="created")


def per_window(deltas: DataFrame, length: str = "1 minute") -> DataFrame:
    """Stream of (start, rows, delta, seconds) summed per window of event time; a window is told once it is complete."""
    sums = deltas.groupBy(F.window("created", length)).agg(
        F.count("*").alias("rows"), F.sum("delta").alias("delta"), F.sum("seconds").alias("seconds"))
    return sums.select(F.col("window.start").alias("start"), "rows", "delta", "seconds")
