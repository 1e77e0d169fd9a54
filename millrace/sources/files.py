"""Readers for delimited files, text lines and inline rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import pin


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = False,
                   **options) -> DataFrame:
    """Delimited file with a stated schema; rows that do not fit raise."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "FAILFAST")
    return reader.options(**options).csv(path)


def read_inferred(spark: SparkSession, path: str, names: list[str] | None = None, sep: str = ",",
                  header: bool = False, sample: float = 1.0) -> DataFrame:
    """Delimited file with types found by reading it once more.

    ``sample`` bounds the share of rows used for the types. Prefer a stated
    schema for large inputs.
    """
    reader = spark.read.option("inferSchema", True).option("samplingRatio", sample)
    df = reader.option("sep", sep).option("header", header).csv(path)
    return df.toDF(*names) if names else df


def read_lines(spark: SparkSession, path: str, name: str = "line", ordinal: str = "id") -> DataFrame:
    """Text lines numbered 1..n in file order; blank lines become NULL.

    The order is (file, block start, line within the block). Lines are counted
    per block and each block starts where the blocks before it end, so only the
    counts are sorted; the text is read twice and never shuffled for its number.
    """
    raw = spark.read.text(path).select(
        F.nullif(F.col("value"), F.lit("")).alias(name),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),  # grows along a block
    )
    blocks = raw.groupBy("_file", "_block").agg(F.count("*").alias("_lines"), F.min("_row").alias("_first"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    starts = pin(blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before")))
    placed = raw.join(starts, ["_file", "_block"])
    return placed.select((F.col("_before") + F.col("_row") - F.col("_first") + 1).alias(ordinal), name)


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows, by ``order`` when the choice must be repeatable."""
    return (df.orderBy(*order) if order else df).limit(n)


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """Row count of a Parquet table from its footers (no column is read)."""
    return spark.read.parquet(path).agg(F.count("*").alias("row_count"))
