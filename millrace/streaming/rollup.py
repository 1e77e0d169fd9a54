"""Sales rollup that follows a queue of order ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans import rollup
from millrace.streaming import batches, queue

DELTA_SCHEMA = "CustomerID bigint, StockItemID bigint, SalesMonth int, SalesYear int, Quantity bigint, TotalItemSale decimal(19,4)"
ID_SCHEMA = "OrderID bigint"


class OrderRollup:
    """Consumes order messages; ``tables()`` gives (lines, orders, customers, items).

    ``add`` writes what each batch adds: an order that is announced again is
    counted again. ``recompute`` only remembers which orders were announced and
    reads their present lines, which stays right when orders are updated.
    """

    def __init__(self, spark: SparkSession, root: str, tables: Callable[[], tuple], mode: str = "add"):
        if mode not in ("add", "recompute"):
            raise ValueError(f"unknown mode {mode}")
        self.spark, self.root, self.tables, self.mode = spark, root.rstrip("/"), tables, mode

    def on_batch(self, messages: DataFrame, batch_id: int) -> None:
        taken = queue.received(messages).persist()  # parsed once for errors and ids
        batches.write_batch(queue.errors(taken), f"{self.root}/errors", batch_id)
        batches.write_batch(queue.unhandled(messages), f"{self.root}/unhandled", batch_id)
        times = queue.fan_out(taken).groupBy("OrderID").agg(F.count("*").alias("_times"))
        if self.mode == "recompute":
            batches.write_batch(times.select("OrderID"), f"{self.root}/orders", batch_id)
        else:
            batches.write_batch(self._delta(times), f"{self.root}/deltas", batch_id)
        taken.unpersist()

    def _delta(self, times: DataFrame) -> DataFrame:
        lines, orders, customers, items = self.tables()
        # the id span of the batch is a plain value: scans skip files and row groups outside it
        span = times.agg(F.min("OrderID").alias("lo"), F.max("OrderID").alias("hi")).first()
        within = F.col("OrderID").between(span["lo"], span["hi"])
        lines, orders = lines.where(within), orders.where(within)
        counted = lines.join(times, "OrderID").withColumns({
            "Quantity": F.col("Quantity") * F.col("_times"),
            "Price": (F.col("Price") * F.col("_times").cast("decimal(10,0)")),
        })
        announced = orders.join(times.select("OrderID"), "OrderID", "left_semi")
        delta = rollup.sales_rollup(counted.drop("_times"), announced, customers, items)
        return delta.select(*[F.col(p.split()[0]).cast(p.split()[1]) for p in DELTA_SCHEMA.split(", ")])

    def errors(self) -> DataFrame:
        return batches.read_batches(self.spark, f"{self.root}/errors", queue.ERROR_SCHEMA)

    def read(self) -> DataFrame:
        """The rollup of everything received so far."""
        if self.mode == "recompute":
            seen = batches.read_batches(self.spark, f"{self.root}/orders", ID_SCHEMA).select("OrderID").distinct()
            lines, orders, customers, items = self.tables()
            return rollup.sales_rollup(lines, orders.join(seen, "OrderID", "left_semi"), customers, items)
        upto = self._merged_upto()
        deltas = batches.read_batches(self.spark, f"{self.root}/deltas", DELTA_SCHEMA)
        deltas = deltas.where(F.col("batch_id") > upto).drop("batch_id")
        if upto >= 0:
            deltas = deltas.unionByName(self.spark.read.schema(DELTA_SCHEMA).parquet(f"{self.root}/base/batch_id={upto}"))
        return deltas.groupBy(*rollup.KEYS).agg(*[F.sum(m).alias(m) for m in rollup.MEASURES])

    def compact(self) -> None:
        """Merge all finished batches into a new base, so that readers see few files.

        Call it between runs of the stream. The base is named after the last
        batch in it, and readers take only later batches.
        """
        done = batches.batch_ids(self.spark, f"{self.root}/deltas")
        if done and done[-1] > self._merged_upto():
            rows = self.read().select(*[F.col(p.split()[0]).cast(p.split()[1]) for p in DELTA_SCHEMA.split(", ")])
            batches.write_batch(rows, f"{self.root}/base", done[-1])

    def _merged_upto(self) -> int:
        return max(batches.batch_ids(self.spark, f"{self.root}/base"), default=-1)
