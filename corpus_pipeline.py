"""From documents to packed training sequences: clean, remove repeats, decontaminate, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, linededup, neardup, packing, quality
from millrace.llm.common import Scratch, table
from millrace.llm.queries import tokenizer_file


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return quality.cleaned(docs)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later places of repeated passages; one that has nothing else left goes."""
    left = linededup.deduplicated(docs, "_lines_all", "_lines_lost").where("_lines_lost = 0 or _lines_all > _lines_lost")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by five-word windows and a similarity of 0.8."""
    gone = neardup.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = decontaminate.contaminated_spans(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of 4096 tokens."""
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality rules", clean_lines),
    ("line dedup", remove_repeated_lines),
    ("near dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_passages),
    ("packing", pack),
]

#: Near duplicates, edit distances and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies ``STAGES`` to documents; each result is written and read again."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
