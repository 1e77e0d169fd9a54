"""Stored inverted indexes: rows (term, id, ...) in loads, each sorted by term.

``root/postings/load=N`` holds the rows of a load in range parts of the term, so
row groups cover few terms; min, max and a Bloom filter of each row group let a
scan skip those that hold none of the wanted terms. ``root/ids/load=N`` and
``root/counts/load=N`` belong to it. A load that is written again replaces its
own folders only. ``merge_loads`` makes one load of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import path_exists

#: Wanted terms that are sent to the scan as a list; more meet the postings by join.
LISTED = 1000
#: Bytes of a row group: small, because a lookup reads whole row groups.
GROUP_BYTES = 1 << 20


def _numbers(spark: SparkSession, path: str) -> list[int]:
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [status.getPath().getName() for status in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(int(n.removeprefix("load=")) for n in names if n.startswith("load="))


def _write_sorted(rows: DataFrame, path: str) -> None:
    placed = rows.repartitionByRange("term").sortWithinPartitions("term", "id")
    writer = placed.write.mode("overwrite").option("parquet.bloom.filter.enabled#term", "true").option("parquet.block.size", GROUP_BYTES)
    writer.parquet(path)


def new_ids(rows: DataFrame, root: str, load: int) -> DataFrame:
    """Rows whose id no load but ``load`` has."""
    spark = rows.sparkSession
    if not any(n != load for n in _numbers(spark, f"{root}/ids")):
        return rows
    kind = rows.schema["id"].dataType.simpleString()
    known = spark.read.schema(f"id {kind}, load int").parquet(f"{root}/ids").where(F.col("load") != load).select("id")
    return rows.join(known, "id", "left_anti")


def add_load(rows: DataFrame, root: str, load: int, ids: DataFrame | None = None) -> None:
    """Store the postings (term, id, ...) of ids that no other load has; ``rows`` holds each (term, id) once.

    Pass ``ids`` when it is known which new ids ``rows`` is of, each once: postings
    are many times as many, and then neither joined nor grouped by id.
    """
    spark = rows.sparkSession
    rows = new_ids(rows, root, load) if ids is None else rows
    _write_sorted(rows, f"{root}/postings/load={load}")
    own = spark.read.schema(rows.schema).parquet(f"{root}/postings/load={load}")
    (own.select("id").distinct() if ids is None else ids.select("id")).write.mode("overwrite").parquet(f"{root}/ids/load={load}")
    own.groupBy("term").agg(F.count("*").alias("cnt")).write.mode("overwrite").parquet(f"{root}/counts/load={load}")


def merge_loads(spark: SparkSession, root: str, to: str) -> None:
    """All loads as load 0 of a new index, for when many small ones have come together."""
    rows = spark.read.parquet(f"{root}/postings").drop("load")
    add_load(rows, to, 0)


def postings(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/postings").drop("load")


def counts(spark: SparkSession, root: str) -> DataFrame:
    """In how many ids each term is, over all loads."""
    return spark.read.parquet(f"{root}/counts").groupBy("term").agg(F.sum("cnt").alias("cnt"))


def wanted(index: DataFrame, terms: list) -> DataFrame:
    """Postings of listed terms; the list reaches the scan, where a longer one than Spark expects would shrink to its least and largest term."""
    index.sparkSession.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", LISTED)
    return index.where(F.col("term").isin(list(dict.fromkeys(terms))))


def looked_up(index: DataFrame, terms: DataFrame, term: str | Column) -> DataFrame:
    """``terms`` with the postings of their term.

    Up to ``LISTED`` distinct terms are also sent to the scan as a list, so only
    row groups that may hold them are read; more terms than that read the index.
    """
    name = F.col(term) if isinstance(term, str) else term
    asked = terms.withColumn("term", name)
    some = [r[0] for r in asked.select("term").distinct().limit(LISTED + 1).collect()]
    near = wanted(index, some) if len(some) <= LISTED else index
    return asked.join(near, "term")


def ids_with_all(index: DataFrame, terms: list) -> DataFrame:
    """Ids that hold every listed term."""
    listed = list(dict.fromkeys(terms))
    hits = wanted(index, listed).groupBy("id").agg(F.count("*").alias("n"))
    return hits.where(F.col("n") == len(listed)).select("id")
