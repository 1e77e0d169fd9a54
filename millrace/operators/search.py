"""Name search over character trigrams, and array element lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import postings
from millrace.session import pin

BEST = 3  # fixed value: how many of the rarest trigrams a search uses


def trigram_index(names: DataFrame, id_col: str, name_col: str, keep_name: bool = False) -> DataFrame:
    """Distinct ``(trigram, id)`` pairs; written sorted by trigram it serves lookups.

    ``keep_name`` carries the name along, so that a search needs no join back to it.
    """
    carried = [F.col(name_col).alias("name")] if keep_name else []
    return names.select(F.explode(tx.ngrams(F.col(name_col))).alias("trigram"), F.col(id_col).alias("id"), *carried)


def trigram_frequency(index: DataFrame) -> DataFrame:
    """How many ids hold each trigram."""
    return index.groupBy("trigram").agg(F.count("*").alias("cnt"))


def add_names(names: DataFrame, id_col: str, name_col: str, root: str, load: int) -> None:
    """Add names with new ids to the index stored under ``root``; writing a load again replaces its part only.

    Which ids are new is settled on the names, written once, before they become
    trigrams. Repeated rows go by hash, so only distinct ones are sorted for one name per id.
    """
    rows = pin(names.select(F.col(id_col).alias("id"), F.col(name_col).alias("name")).distinct(), "names")
    named = rows.where(F.size(tx.ngrams(F.col("name"))) > 0)
    fresh = pin(postings.new_ids(named if id_col == name_col else named.dropDuplicates(["id"]), root, load), "names")
    postings.add_load(trigram_index(fresh, "id", "name", keep_name=True).withColumnRenamed("trigram", "term"), root, load, fresh)


def stored_index(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Postings (trigram, id, name) and frequency (trigram, cnt) of all loads."""
    return tuple(df.withColumnRenamed("term", "trigram") for df in (postings.postings(spark, root), postings.counts(spark, root)))


def best_trigrams(searches: DataFrame, frequency: DataFrame, query_id: str, text_col: str) -> DataFrame:
    """The rarest known trigrams of each search text, ranked 1..3 (ties by trigram)."""
    wanted = searches.select(query_id, F.explode(tx.ngrams(F.col(text_col))).alias("trigram"))
    rank = Window.partitionBy(query_id).orderBy("cnt", "trigram")
    ranked = wanted.join(frequency, "trigram").withColumn("rn", F.row_number().over(rank))
    return ranked.where(F.col("rn") <= BEST)


def best_trigrams_wide(best: DataFrame, query_id: str) -> DataFrame:
    """The ranked trigrams of a search side by side."""
    picked = [F.max(F.when(F.col("rn") == k, F.col("trigram"))).alias(f"trigram{k}") for k in range(1, BEST + 1)]
    return best.groupBy(query_id).agg(*picked)


def matching_names(wide: DataFrame, index: DataFrame, query_id: str) -> DataFrame:
    """Names that hold every chosen trigram of a search, as ``query_id, id, name``.

    ``index`` carries the names. Searches with the same trigrams are looked up
    once. Only the postings of the rarest trigram are read, from a stored index
    only the row groups that may hold it; the other two are checked on the name
    itself, which equals the intersection of the id lists.
    """
    picks = [f"trigram{k}" for k in range(1, BEST + 1)]
    keyed = wide.where(F.col(picks[0]).isNotNull()).select(query_id, F.array_compact(F.array(*picks)).alias("_set"))
    sets = keyed.select("_set").distinct().withColumn("_rarest", F.element_at("_set", 1))
    found = postings.looked_up(index.withColumnRenamed("trigram", "term"), sets, "_rarest")
    others = F.slice("_set", 2, BEST)
    kept = found.where(F.forall(others, lambda t: F.contains(F.col("name"), t)))
    return keyed.join(kept.select("_set", "id", "name"), "_set").select(query_id, "id", "name")


def name_search(searches: DataFrame, names: DataFrame, query_id: str, text_col: str, id_col: str,
                name_col: str, index: DataFrame | None = None,
                frequency: DataFrame | None = None) -> DataFrame:
    """Names that share the best trigrams, for a whole table of searches.

    Pass a stored ``index`` (with names) and ``frequency`` when they exist. The
    chosen trigrams are pinned: one row per search, used twice.
    """
    index = trigram_index(names, id_col, name_col, keep_name=True) if index is None else index
    frequency = trigram_frequency(index) if frequency is None else frequency
    wide = pin(best_trigrams_wide(best_trigrams(searches, frequency, query_id, text_col), query_id))
    return matching_names(wide, index, query_id).withColumnRenamed("name", name_col)


def name_totals(hits: DataFrame, facts: DataFrame, fact_id: str, group: list[str], date: str, amount: str,
                start_year: int, years: int, top_n: int, query_id: str, name_col: str) -> DataFrame:
    """Top names per search by summed amount over ``start_year`` up to, not with, the end year.

    The years become bounds of the raw ``date``, which reach the scan.
    """
    first, end = (F.lit(f"{y:04d}-01-01").cast(facts.schema[date].dataType) for y in (start_year, start_year + years))
    window = (F.col(date) >= first) & (F.col(date) < end)
    wanted = facts.where(window).groupBy(F.col(fact_id).alias("id"), *group).agg(F.sum(amount).alias("_part"))
    summed = hits.join(wanted, "id").groupBy(query_id, name_col, *group).agg(F.sum("_part").alias("total"))
    rank = Window.partitionBy(query_id).orderBy(F.desc("total"), name_col, *group)
    return summed.withColumn("_rn", F.row_number().over(rank)).where(F.col("_rn") <= top_n).drop("_rn")


def element_index(df: DataFrame, array: str, id_col: str) -> DataFrame:
    """Inverted index ``(term, id)`` over the distinct elements of an array column; ``postings`` stores and searches it."""
    return df.select(F.explode(F.array_distinct(array)).alias("term"), F.col(id_col).alias("id"))
