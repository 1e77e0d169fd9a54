"""Writers: exports, loads, and time- or hash-partitioned table layout.

A table is a folder of Parquet files. Partition columns are derived from the
row, so pruning needs the matching filter on the derived column: ``read_span``
adds it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates

MONTH = "part_month"


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    df.write.option("header", header).option("sep", sep).csv(path)


def save_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def bulk_append(df: DataFrame, path: str, max_rows_per_file: int = 0) -> None:
    """Append all rows in one distributed write; the row bound only cuts files."""
    df.write.mode("append").option("maxRecordsPerFile", max_rows_per_file).parquet(path)


def reload(df: DataFrame, path: str) -> None:
    """Replace the table contents."""
    df.write.mode("overwrite").parquet(path)


def month_key(ts: str | Column) -> Column:
    """Partition text of the month, ``'2024-03'``."""
    return F.date_format(ts, "yyyy-MM")


def check_span(df: DataFrame, ts: str, start: dt.datetime, stop: dt.datetime) -> DataFrame:
    """The rows themselves; a row outside ``[start, stop)`` (or without time) is an error."""
    lo, hi = dates.as_ntz(start.isoformat(sep=" ")), dates.as_ntz(stop.isoformat(sep=" "))
    inside = F.coalesce(dates.half_open(F.col(ts), lo, hi), F.lit(False))
    checked = F.assert_true(inside, F.lit("no partition for row"))
    return df.withColumn(ts, F.when(checked.isNull(), F.col(ts)))


def _one_folder_each(df: DataFrame, *names: str) -> DataFrame:
    """Bring the rows of a folder together before the write.

    The rebalance hint lets AQE cut folders that hold much of the data into
    several tasks and files, and pack small folders into shared tasks.
    """
    return df.hint("rebalance", *names)


def write_months(df: DataFrame, path: str, ts: str, mode: str = "append") -> None:
    """One folder per month."""
    keyed = df.withColumn(MONTH, month_key(ts))
    _one_folder_each(keyed, MONTH).write.mode(mode).partitionBy(MONTH).parquet(path)


def read_span(spark: SparkSession, path: str, ts: str, start: dt.datetime | None = None,
              stop: dt.datetime | None = None, after: dt.datetime | None = None) -> DataFrame:
    """Rows with ``start <= ts < stop`` (or ``ts > after``), reading only the months in reach."""
    df = spark.read.parquet(path)
    month, moment = F.col(MONTH).cast("string"), F.col(ts)
    if start is not None:
        df = df.where((month >= start.strftime("%Y-%m")) & (moment >= _ntz(start)))
    if after is not None:
        df = df.where((month >= after.strftime("%Y-%m")) & (moment > _ntz(after)))
    if stop is not None:
        df = df.where((month <= stop.strftime("%Y-%m")) & (moment < _ntz(stop)))
    return df


def _ntz(moment: dt.datetime) -> Column:
    return dates.as_ntz(moment.isoformat(sep=" "))


def write_time_buckets(df: DataFrame, path: str, ts: str, seconds: int, name: str = "part_start") -> None:
    """Fixed-width time buckets, grouped into one folder per day.

    Inside a day the rows are sorted by bucket start, so a filter on it skips
    row groups; a folder per bucket would give very many small files.
    """
    start = dates.bucket_start(F.col(ts), seconds)
    placed = df.withColumn(name, start).withColumn("part_day", F.date_format(start, "yyyy-MM-dd"))
    spread = _one_folder_each(placed, "part_day")
    spread.sortWithinPartitions("part_day", name, ts).write.partitionBy("part_day").parquet(path)


def write_hash_parts(df: DataFrame, path: str, key: str, parts: int, name: str = "part_no") -> None:
    """A fixed number of disjoint folders by key hash."""
    placed = df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(parts)))
    _one_folder_each(placed, name).write.partitionBy(name).parquet(path)


def write_time_chunks(df: DataFrame, path: str, ts: str, segment: list[str], name: str = "part_week") -> None:
    """Weekly folders, rows sorted by segment columns and then time (small, prunable row groups)."""
    week = F.date_format(F.date_trunc("week", F.col(ts)), "yyyy-MM-dd")
    placed = _one_folder_each(df.withColumn(name, week), name)
    placed.sortWithinPartitions(name, *segment, ts).write.partitionBy(name).parquet(path)


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _months(spark: SparkSession, path: str) -> list[str]:
    """Month folders of a table, from the folder listing only."""
    folder, fs = _fs(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(folder) if status.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{MONTH}="))


def drop_months_before(spark: SparkSession, path: str, cutoff: str) -> list[str]:
    """Retention: delete whole month folders with key < ``cutoff`` (``'2024-02'``)."""
    dropped = [m for m in _months(spark, path) if m < cutoff]
    for month in dropped:
        folder, fs = _fs(spark, f"{path}/{MONTH}={month}")
        fs.delete(folder, True)
    return dropped


def detach_month(spark: SparkSession, path: str, month: str, side_path: str) -> None:
    """Move one month out of the table; the side path is a plain table."""
    source, fs = _fs(spark, f"{path}/{MONTH}={month}")
    target, _ = _fs(spark, side_path)
    if not fs.rename(source, target):
        raise FileNotFoundError(f"no partition {month} in {path}")


def attach_month(spark: SparkSession, path: str, month: str, side_path: str, ts: str) -> None:
    """Move a detached month back after checking that every row belongs to it."""
    bounds = spark.read.parquet(side_path).agg(
        F.min(month_key(ts)).alias("lo"), F.max(month_key(ts)).alias("hi"),
        F.count(F.when(F.col(ts).isNull(), 1)).alias("untimed"),
    ).first()
    if bounds["untimed"] or (bounds["lo"] is not None and (bounds["lo"], bounds["hi"]) != (month, month)):
        raise ValueError(f"rows outside partition {month}: {bounds['lo']}..{bounds['hi']}")
    source, fs = _fs(spark, side_path)
    target, _ = _fs(spark, f"{path}/{MONTH}={month}")
    if not fs.rename(source, target):
        raise FileExistsError(f"partition {month} is already attached")


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Table whose files were written before and after a column was added."""
    return spark.read.option("mergeSchema", True).parquet(path)


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """New table version with a column that is NULL in all old rows."""
    return df.withColumn(name, F.lit(None).cast(kind))
