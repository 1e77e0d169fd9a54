"""Table changes as new table versions: insert-ignore, additive merge, updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: list[str], prefer: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is new; the first by ``prefer`` when a key repeats.

    Append the result to the table. Existing rows always stay as they are.
    """
    kept = [c for c in incoming.columns if c not in keys]
    first = incoming.groupBy(*keys).agg(F.min(F.struct(*prefer, F.struct(*kept).alias("_row"))).alias("_min"))
    rows = first.select(*keys, "_min._row.*")
    return rows.join(current.select(*keys), keys, "left_anti").select(*incoming.columns)


def merge_additive(target: DataFrame, delta: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Matched keys add the measures, new keys are inserted: a union and one sum."""
    both = target.select(*keys, *measures).unionByName(delta.select(*keys, *measures))
    return both.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def changed_rows(new: DataFrame, old: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct new images that do not occur among the old ones."""
    return new.select(*columns).subtract(old.select(*columns))


def update_where_key_in(df: DataFrame, keys: DataFrame, key: str, column: str, value: Column) -> DataFrame:
    """New version of ``df`` with ``column`` set to ``value`` for the listed keys."""
    listed = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(listed, key, "left")
    new = F.when(F.col("_hit"), value).otherwise(F.col(column))
    return joined.withColumn(column, new).select(*df.columns)


def latest_group(df: DataFrame, group: str, moment: str) -> DataFrame:
    """First and last moment of the group that was seen most recently (one row)."""
    spans = df.groupBy(group).agg(F.max(moment).alias("last"), F.min(moment).alias("first"))
    return spans.orderBy(F.desc("last"), group).limit(1)


def top_per_group(df: DataFrame, keys: list[str], order: list, n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each group, optionally with their rank (Spark trims groups before the shuffle)."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= n)
    return kept.withColumn(name, F.col(name).cast("bigint")) if rank else kept.drop(name)
