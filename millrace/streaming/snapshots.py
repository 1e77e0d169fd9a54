"""Statistics snapshots on a stream: timed sums, live deltas, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.operators import ordered
from millrace.plans import alerts, monitoring
from millrace.session import pin
from millrace.streaming import batches

SNAPSHOT_SCHEMA = "created timestamp_ntz, calls bigint, total_value decimal(38,2)"


def snapshot_batch(path: str, created: str, amount: str):
    """``foreachBatch`` function: one summary row per micro-batch."""

    def on_batch(df: DataFrame, batch_id: int) -> None:
        row = df.agg(
            F.max(created).cast("timestamp_ntz").alias("created"), F.count("*").alias("calls"),
            F.sum(F.col(amount).cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_value"),
        )
        batches.write_batch(row, path, batch_id)

    return on_batch


def snapshot_job(root: str, roles: DataFrame, databases: DataFrame, log_position: Column, started: Column, taken: str = "taken",
                 counters: list[str] = monitoring.COUNTERS):
    """``foreachBatch`` function of the timed job: each dump of the statistics view becomes a snapshot of all its counters.

    A dump is the rows with one ``taken``; a batch has the dumps that have come
    since the last one (bounded by the files that a batch takes). A dump is
    committed over its three tables at once, and a batch that runs again writes
    the same snapshots.
    """

    def on_batch(df: DataFrame, batch_id: int) -> None:
        dumps = pin(df, "dumps")
        for moment in sorted(r[0] for r in dumps.select(taken).distinct().collect()):
            rows = dumps.where(F.col(taken) == F.lit(moment)).drop(taken)
            monitoring.ingest_snapshot(rows, roles, databases, root, moment, log_position, started, counters)

    return on_batch


class LiveDeltas:
    """Differences of a growing counter to the row before of its key, as rows arrive.

    Rows hold the key columns, ``created``, ``stats_reset`` and the counter; a
    key has one row at a time. A changed ``stats_reset`` starts over with NULL,
    as does a NULL counter; counters are subtracted as integers. Each batch
    joins the last row per key of the batch before and writes its own version of
    them, so a replayed batch starts from the same state. Rows that are not
    later than that state are set aside, and ``read`` works out their keys anew:
    the result does not depend on the order of arrival.
    """

    def __init__(self, spark: SparkSession, root: str, key_schema: str, counter: str):
        self.spark, self.root, self.counter = spark, root.rstrip("/"), counter
        self.keys = [field.split()[0] for field in key_schema.split(", ")]
        self.schema = f"{key_schema}, created timestamp_ntz, stats_reset timestamp_ntz, {counter} bigint"
        self.columns = [*self.keys, "created", "stats_reset", counter]

    def _version(self, name: str, batch: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/{name}/batch_id={batch}")

    def _deltas(self, rows: DataFrame) -> DataFrame:
        stamped = rows.withColumn("_at", F.col("created"))
        lagged = ordered.with_previous(stamped, self.keys, "created", ["_at", "stats_reset", self.counter])
        same = F.col("prev_stats_reset") == F.col("stats_reset")
        seconds = dates.epoch_seconds_between(F.col("created"), F.col("prev__at"))
        return lagged.withColumns({
            "delta": F.when(same, F.col(self.counter) - F.col(f"prev_{self.counter}")), "seconds": F.when(same, seconds)})

    def on_batch(self, df: DataFrame, batch_id: int) -> None:
        rows = df.select(*self.columns)
        before = [b for b in batches.batch_ids(self.spark, f"{self.root}/state") if b < batch_id]
        state = self._version("state", before[-1]) if before else rows.limit(0)
        met = rows.join(state.select(*self.keys, F.col("created").alias("_last")), self.keys, "left")
        on_time = met.where("_last IS NULL OR created > _last").select(*self.columns)
        batches.write_batch(met.where("created <= _last").select(*self.columns), f"{self.root}/late", batch_id)
        ordered_rows = on_time.withColumn("_new", F.lit(True)).unionByName(state.withColumn("_new", F.lit(False)))
        fresh = self._deltas(ordered_rows).where("_new").select(*self.columns, "delta", "seconds")
        batches.write_batch(fresh, f"{self.root}/deltas", batch_id)
        latest = ordered_rows.groupBy(*self.keys).agg(F.max_by(F.struct("created", "stats_reset", self.counter), "created").alias("l"))
        batches.write_batch(latest.select(*self.keys, "l.*"), f"{self.root}/state", batch_id)

    def read(self) -> DataFrame:
        """All rows so far with ``delta`` and ``seconds``."""
        out = [*self.columns, "delta", "seconds"]
        timely = batches.read_batches(self.spark, f"{self.root}/deltas", f"{self.schema}, delta bigint, seconds double").select(*out)
        late = batches.read_batches(self.spark, f"{self.root}/late", self.schema).select(*self.columns)
        if late.isEmpty():
            return timely
        keys = late.select(*self.keys).distinct()
        again = timely.select(*self.columns).join(keys, self.keys, "left_semi").unionByName(late)
        return timely.join(keys, self.keys, "left_anti").unionByName(self._deltas(again).select(*out))


class AlertJob:
    """Keeps the table of long-running sessions while snapshots of active sessions arrive.

    A batch writes only the rows that it adds or changes; the table is the latest
    row per session. A replayed batch starts from the batches before it.
    """

    def __init__(self, spark: SparkSession, root: str, session_schema: str, as_of: Column, **filters):
        self.spark, self.root, self.as_of, self.filters = spark, root.rstrip("/"), as_of, filters
        self.schema = (f"{session_schema}, email_sent boolean, email_time timestamp_ntz, "
                       "email2_sent boolean, email2_time timestamp_ntz")

    def known(self, before: int | None = None) -> DataFrame:
        found = [b for b in batches.batch_ids(self.spark, f"{self.root}/known") if before is None or b < before]
        if not found:
            return self.spark.createDataFrame([], self.schema)
        rows = batches.read_batches(self.spark, f"{self.root}/known", self.schema).where(F.col("batch_id") <= found[-1])
        columns = [c for c in rows.columns if c not in (*alerts.KEY, "batch_id")]
        latest = rows.groupBy(*alerts.KEY).agg(F.max_by(F.struct(*columns), "batch_id").alias("r"))
        return latest.select(*alerts.KEY, "r.*").select(*[c for c in rows.columns if c != "batch_id"])

    def on_batch(self, active: DataFrame, batch_id: int) -> None:
        active = pin(active, "active")
        old = self.known(before=batch_id)
        fresh = alerts.new_long_running(active, old, self.as_of, **self.filters)
        told = pin(alerts.mark_low(old.unionByName(fresh.select(*old.columns)), self.as_of), "told")
        late = alerts.escalations(told, active, self.as_of)
        changed = alerts.mark_high(told, late, self.as_of).exceptAll(old)
        batches.write_batch(changed, f"{self.root}/known", batch_id)
