"""Per-station minimum, mean and maximum over very many readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import pin_sorted


def station_summary(readings: DataFrame, station: str = "station_name",
                    measurement: str = "measurement") -> DataFrame:
    """min, mean (one decimal, half away from zero) and max per station, sorted.

    One partial aggregation per task, then one small shuffle.
    """
    value = F.col(measurement)
    summary = readings.groupBy(station).agg(
        F.min(value).alias("min_measurement"),
        F.round(F.avg(value), 1).alias("mean_measurement"),
        F.max(value).alias("max_measurement"),
    )
    return summary.orderBy(station)


def summary_line(summary: DataFrame, station: str = "station_name") -> DataFrame:
    """The whole summary as one text ``{a=min/mean/max, ...}``, from one row per station.

    The parts of a sort by station are joined to texts side by side; the last
    step puts one text per part together.
    """
    figures = F.concat_ws("/", "min_measurement", "mean_measurement", "max_measurement")
    entries = summary.select(F.col(station).alias("k"), F.concat(F.col(station), F.lit("="), figures).alias("v"))
    placed = pin_sorted(entries, ["k"])
    parts = placed.groupBy("_part").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("items"))
    texts = parts.select("_part", F.array_join("items.v", ", ").alias("text"))
    whole = F.array_join(F.array_sort(F.collect_list(F.struct("_part", "text")))["text"], ", ")
    return texts.agg(F.concat(F.lit("{"), whole, F.lit("}")).alias("result"))


def summary_entries(readings: DataFrame, station: str, measurement: str, mean_type: str = "decimal(8,1)") -> DataFrame:
    """One ``station=min/mean/max`` text per station, the mean cast to ``mean_type``."""
    value = F.col(measurement)
    grouped = readings.groupBy(station).agg(
        F.min(value).alias("lo"), F.avg(value).cast(mean_type).alias("mean"), F.max(value).alias("hi")
    )
    return grouped.select(F.concat(F.col(station), F.lit("="), F.concat_ws("/", "lo", "mean", "hi")).alias("entry"))
