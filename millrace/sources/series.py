"""Generated series: integers, fractions, times, and device grids.

Whole-table series start from ``spark.range`` so that generation is spread
over the executors; per-row series expand a guarded ``sequence``.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _count(start, stop, step) -> int:
    """How many values lie from ``start`` to ``stop`` (inclusive) in ``step``s."""
    zero = type(step)(0) if not isinstance(step, dt.timedelta) else dt.timedelta(0)
    if step == zero:
        raise ValueError("step size cannot be zero")
    span = stop - start
    if (step > zero and span < zero) or (step < zero and span > zero):
        return 0
    return int(span // step) + 1


def int_series(spark: SparkSession, start: int, stop: int, step: int = 1, name: str = "value") -> DataFrame:
    """Integers from ``start`` to ``stop`` inclusive; empty when the step leads away."""
    n = _count(start, stop, step)
    return spark.range(n).select((F.col("id") * step + start).alias(name))


def frac_series(spark: SparkSession, start: str, stop: str, step: str, name: str = "value") -> DataFrame:
    """Exact decimal series; bounds and step as text."""
    first, width = Decimal(start), Decimal(step)
    n = _count(first, Decimal(stop), width)
    scale = max(0, -first.as_tuple().exponent, -width.as_tuple().exponent)
    kind = f"decimal(30,{scale})"
    value = F.col("id").cast("decimal(18,0)") * F.lit(width) + F.lit(first)
    return spark.range(n).select(value.cast(kind).alias(name))


def ts_series(spark: SparkSession, start: dt.datetime, stop: dt.datetime, step: dt.timedelta,
              name: str = "time", ordinal: str | None = None) -> DataFrame:
    """Zone-less timestamps; the end is included only when a step hits it."""
    n = _count(start, stop, step)
    out = spark.range(n).select(_shifted(start, F.col("id"), step).alias(name), (F.col("id") + 1).alias("_n"))
    return out.drop("_n") if ordinal is None else out.withColumnRenamed("_n", ordinal)


def back_from(spark: SparkSession, as_of: dt.datetime, back: dt.timedelta, step: dt.timedelta,
              name: str = "time") -> DataFrame:
    """Series over the time before ``as_of``, which is a parameter and not the clock."""
    return ts_series(spark, as_of - back, as_of, step, name)


#: Cells that one task makes: what it groups them by may be as large as they are.
CELLS = 1 << 20


def device_grid(spark: SparkSession, start: dt.datetime, stop: dt.datetime, step: dt.timedelta,
                devices: int, first_device: int = 1) -> DataFrame:
    """Every time with every device id, from one range (no cross join)."""
    cells = _count(start, stop, step) * devices
    parts = max(spark.sparkContext.defaultParallelism, -(-cells // CELLS))
    cell = F.col("id")
    return spark.range(0, cells, 1, parts).select(
        _shifted(start, F.floor(cell / devices).cast("bigint"), step).alias("time"),
        (cell % devices + first_device).alias("device_id"),
    )


def _shifted(start: dt.datetime, index: Column, step: dt.timedelta) -> Column:
    width = int(step / dt.timedelta(microseconds=1))
    base = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", index * F.lit(width), base)


def expand_ints(df: DataFrame, lo: Column, hi: Column, name: str, step: int = 1) -> DataFrame:
    """Per-row integer series; rows whose step leads away give none."""
    runs = (lo <= hi) if step > 0 else (lo >= hi)
    series = F.when(runs, F.sequence(lo, hi, F.lit(step).cast("bigint")))
    return df.select("*", F.explode(series).alias(name))


def expand_fractions(df: DataFrame, lo: Column, hi: Column, step: str, name: str) -> DataFrame:
    """Per-row decimal series."""
    width = Decimal(step)
    steps = F.floor((hi - lo) / F.lit(width)).cast("bigint")
    index = F.when(steps >= 0, F.sequence(F.lit(0).cast("bigint"), steps))
    out = df.select("*", F.explode(index).alias("_i"))
    return out.withColumn(name, lo + F.col("_i").cast("decimal(18,0)") * F.lit(width)).drop("_i")


def expand_times(df: DataFrame, start: Column, stop: Column, step: dt.timedelta, name: str) -> DataFrame:
    """Per-row timestamp series."""
    width = int(step / dt.timedelta(microseconds=1))
    span = F.timestamp_diff("MICROSECOND", start, stop)
    steps = F.floor(span / F.lit(width)).cast("bigint")
    index = F.when(span >= 0, F.sequence(F.lit(0).cast("bigint"), steps))
    out = df.select("*", F.explode(index).alias("_i"))
    return out.withColumn(name, F.timestamp_add("MICROSECOND", F.col("_i") * F.lit(width), start)).drop("_i")


def expand_in_step(df: DataFrame, series: dict[str, Column]) -> DataFrame:
    """Several per-row series side by side, the shorter ones padded with NULL."""
    named = df.select("*", *[values.alias(name) for name, values in series.items()])
    keep = [c for c in df.columns]
    return named.select(*keep, F.inline(F.arrays_zip(*series)))
