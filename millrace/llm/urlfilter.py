"""URL verdicts: host and path rules first, else association rules mined from labelled pages.

The tokens of a URL are its scheme, host, first and last host label, path
segments, query parameters and fragment, with numbers masked. FP-growth over
the labelled pages finds token sets that go with bad labels. Rules below the
support or the confidence are pruned, and rules that contain a smaller rule,
which match nothing more. Each rule is indexed under its rarest token; a URL
meets only the rules of its own tokens and is checked for the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

BAD = "class:bad"
#: Part of the labelled pages a rule needs, pages it needs at least, part of these that must be bad.
SUPPORT, LEAST_PAGES, CONFIDENCE = 0.001, 25, 0.6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    before = F.substring_index(url, "://", 1)
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.length(before) + 4)).otherwise("")


def host_of(url: Column) -> Column:
    """Host up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for a null url."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: str = "url", host: str = "host", path: str = "path") -> Column:
    """Distinct tokens of the columns; numbers are masked by 0."""
    return F.expr(f"""
        filter(array_distinct(concat(
          array('scheme:' || lower(substring_index({url}, '://', 1)), 'host:' || {host}),
          if(instr({host}, '.') > 0, array('first:' || substring_index({host}, '.', 1), 'last:' || substring_index({host}, '.', -1)), array()),
          transform(split({path}, '/'), (x, i) -> 'path' || i || ':' || regexp_replace(x, '[0-9]+', '0')),
          transform(split(regexp_extract({url}, '[?]([^#]*)', 1), '&'), x -> 'query:' || regexp_replace(x, '[0-9]+', '0')),
          array('fragment:' || regexp_extract({url}, '#(.*)$', 1)))),
          x -> substring_index(x, ':', -1) <> '' or x like 'host:%')""")


def labelled_items(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """items: tokens of each labelled page, and ``BAD`` if a label of it has quality 0 or is toxic.

    A label belongs to the page with the same id. Labels with neither value say nothing.
    """
    said = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(
        F.max(F.expr("coalesce(quality = 0, false) or coalesce(toxic = 1, false)")).alias("bad"))
    met = pages.where("url is not null").join(said, F.col("page_id") == F.col("doc_id"))
    tokens = met.select("bad", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return tokens.select(F.when(F.col("bad"), F.array_append(tokens_of(), F.lit(BAD))).otherwise(tokens_of()).alias("items"))


def mined_rules(items: DataFrame, support: float = SUPPORT, least_pages: int = LEAST_PAGES, confidence: float = CONFIDENCE) -> DataFrame:
    """(tokens, index_token, confidence, support) of the minimal rules ``tokens -> BAD``; none if there are no items."""
    spark = items.sparkSession
    scratch = Scratch(spark, "urlfilter")
    items = scratch.pin(items)
    n = items.count()
    if n < least_pages:
        return spark.range(0).selectExpr("array('') as tokens", "'' as index_token", "0d as confidence", "0d as support")
    model = FPGrowth(itemsCol="items", minSupport=max(support, least_pages / n), minConfidence=confidence).fit(items)
    rules = model.associationRules.where(F.element_at("consequent", 1) == BAD).select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    often = model.freqItemsets.where("size(items) = 1").select(F.element_at("items", 1).alias("token"), "freq")
    placed = rules.select("*", F.explode("tokens").alias("token")).join(often, "token").groupBy("tokens", "confidence", "support").agg(
        F.min_by("token", F.struct("freq", "token")).alias("index_token"))
    placed = scratch.pin(placed)
    parts = placed.select(F.col("tokens").alias("larger"), F.explode("tokens").alias("index_token"))
    contain = parts.join(placed.select("tokens", "index_token"), "index_token").where("size(tokens) < size(larger) and size(array_except(tokens, larger)) = 0")
    return scratch.pin(placed.join(contain.select(F.col("larger").alias("tokens")).distinct(), "tokens", "left_anti"))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, n_rules, confidence): the rules whose tokens are all in the url, for urls that have any."""
    split = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    own = split.select("url", tokens_of().alias("own"))
    met = own.select("url", "own", F.explode("own").alias("index_token")).join(rules, "index_token")
    return met.where("size(array_except(tokens, own)) = 0").groupBy("url").agg(F.count("*").alias("n_rules"), F.max("confidence").alias("confidence"))


def listed(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest (host, path, verdict) rule that fits, else nulls.

    A rule fits its host and the hosts below it, when the path begins with its path.
    """
    ordered = sorted(rules, key=lambda r: len(r[0]) + len(r[1]), reverse=True)
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    rule = reduce(lambda out, r: out.when(fits(r[0], r[1]), r[0] + r[1]), ordered, F.when(F.lit(False), F.lit(None).cast("string")))
    verdict = reduce(lambda out, r: out.when(fits(r[0], r[1]), r[2]), ordered, F.when(F.lit(False), F.lit(None).cast("string")))
    return rule, verdict


def judged(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], **limits) -> DataFrame:
    """page_id, host, path, rule, verdict, n_rules, confidence of each row of ``pages`` (page_id, url).

    ``verdict`` is that of the longest fitting rule; else block if a mined rule
    matches, else allow. A null url, or one without ``://``, has an empty host
    and path. Null ids and repeated rows are judged like any row; other columns
    are ignored. Without labels nothing is mined.
    """
    mined = mined_rules(labelled_items(pages.select("page_id", "url"), labels.select("doc_id", "quality", "toxic")), **limits)
    found = matched(pages.select("url").where("url is not null").distinct(), mined)
    all_ = pages.select("page_id", "url").join(found, "url", "left")
    placed = all_.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.coalesce("n_rules", F.lit(0)).alias("n_rules"), "confidence")
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    return placed.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("n_rules") > 0, "block").otherwise("allow")).alias("verdict"), "n_rules", "confidence")
