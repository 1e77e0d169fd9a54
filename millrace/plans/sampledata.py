"""Sample tables: device readings, wave traffic, drift checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import rand, waves

# Bounds of the sample columns.
CPU_BOUNDS = (3, 100, 4)
TEMPERATURE_BOUNDS = (28, 83)
NOTE_LENGTH = (2, 10)
LOCATION_KEYS = ["building", "rack"]
LOCATION_BOUNDS = (1, 20)


def device_readings(grid: DataFrame, keys: list[str], seed: int, portable: bool = False) -> DataFrame:
    """The grid with cpu, temperature, note and location values per row."""
    row = [F.col(k) for k in keys]

    def draw(label: str) -> Column:
        return rand.uniform(seed, *row, F.lit(label), portable=portable)

    lo, hi, digits = CPU_BOUNDS
    return grid.select(
        "*",
        rand.random_between(draw("cpu"), lo, hi, digits).alias("cpu"),
        rand.random_between(draw("temperature"), *TEMPERATURE_BOUNDS).alias("temperature_c"),
        rand.random_text(seed, *row, F.lit("note"), lo=NOTE_LENGTH[0], hi=NOTE_LENGTH[1], portable=portable).alias("note"),
        rand.random_json(seed, *row, F.lit("location"), keys=LOCATION_KEYS, lo=LOCATION_BOUNDS[0],
                         hi=LOCATION_BOUNDS[1], portable=portable).alias("device_location"),
    )


def shared_note(grid: DataFrame, seed: int, size: int = 10, portable: bool = False) -> DataFrame:
    """One generated text that all rows share (it does not depend on the row)."""
    note = rand.random_text(seed, F.lit("shared"), lo=size, hi=size + 1, gated=False, portable=portable)
    return grid.withColumn("note", note)


def bulk_rows(grid: DataFrame, keys: list[str], seed: int, portable: bool = False) -> DataFrame:
    """Wide load-test rows: four integers, three fractions, two texts; every symbol has its own draw."""
    row = [F.col(k) for k in keys]
    # Fixed values: (lowest, highest, digits) per value column.
    bounds = [(1, 100, 0), (1, 1000, 0), (1, 10000, 0), (1, 100000, 0), (0, 100, 2), (0, 100, 5), (0, 10000, 7)]
    values = [
        rand.random_between(rand.uniform(seed, *row, F.lit(i), portable=portable), lo, hi, digits).alias(f"val{i}")
        for i, (lo, hi, digits) in enumerate(bounds, start=1)
    ]
    texts = [
        rand.random_text(seed, *row, F.lit(f"t{i}"), lo=1, hi=hi, gated=False, portable=portable, draws=1).alias(f"val{i}")
        for i, hi in ((8, 25), (9, 50))
    ]
    return grid.select("*", *values, *texts)


def month_growth(spark) -> DataFrame:
    """Twelve rows: month number and its growth factor."""
    return spark.createDataFrame(waves.MONTH_GROWTH, "m_val int, p_inc double")


def seasonal_traffic(series: DataFrame, ts: str = "ts", rownum: str = "rownum", val: str = "val") -> DataFrame:
    """``(500 + 20 * val) * wave * rownum * month growth`` per day.

    Value and wave come from the same series, so no self-join is needed; the
    twelve month factors are broadcast.
    """
    p_mod = waves.cosine_wave(F.col(rownum), 180, amplitude=0.2, offset=1.0, shift=0)
    base = (F.lit(500) + F.lit(20) * F.col(val)) * p_mod
    monthly = series.withColumn("m_val", F.month(ts)).withColumn("_v", waves.growing(base, F.col(rownum)))
    joined = monthly.join(F.broadcast(month_growth(series.sparkSession)), "m_val")
    return joined.withColumn("value", F.col("_v") * F.col("p_inc")).drop("_v", "m_val", "p_inc")


def drift(readings: DataFrame) -> DataFrame:
    """Means of the sample columns; they approach the middle of their bounds."""
    return readings.agg(F.avg("cpu").alias("avg_cpu"), F.avg("temperature_c").alias("avg_temp"))
