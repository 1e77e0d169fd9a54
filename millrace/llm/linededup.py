"""Removal of repeated passages by windows of three consecutive lines, in DataFrame functions.

The non-blank lines of a document, without blanks at their ends, are hashed;
each three in a row are a window, and so are one or two with a passage of many
words. A window found more than once in the corpus stays where it comes first, by doc_id and place; its later places are covered.
Covered places of a document are merged and its other lines remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

_KEY = ["_doc", "_hash"]

#: Words above which one or two lines are a passage of their own. Fixed value.
PASSAGE_WORDS = 50


def _lined(docs: DataFrame) -> DataFrame:
    """Lines, and for each non-blank line its number and two hashes."""
    keyed = docs.withColumn("_doc", F.col("doc_id")).withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return keyed.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n")).withColumn("_filled", F.expr(
        "filter(transform(_lines, (x, i) -> struct(i, trim(x) as t)), x -> x.t <> '')"))


def windows(docs: DataFrame, words: int | None = PASSAGE_WORDS) -> DataFrame:
    """(_doc, _hash, k, n, a, b): 128 bits of hash for the window of n lines at the k-th non-blank line.

    All of three lines, and those of one or two lines with more than ``words`` words; None: of three lines only.
    """
    counted = "" if words is None else ", regexp_count(x.t, '\\\\S+') as w"
    hashed = _lined(docs).select(*_KEY, F.expr(f"transform(_filled, x -> struct(xxhash64(x.t) as a, xxhash64('b', x.t) as b{counted}))").alias("_h"))

    def of(n: int, long: str = "") -> str:
        """Windows of n lines; shorter ones than three carry their size in the hash."""
        sides = [("" if n == 3 else f"{n}, ") + ", ".join(f"_h[k + {j}].{side}" for j in range(n)) for side in "ab"]
        made = f"struct(k as k, {n} as n, xxhash64({sides[0]}) as a, xxhash64({sides[1]}) as b)"
        every = f"transform(slice(_h, 1, greatest(size(_h) - {n - 1}, 0)), (x, k) -> {f'if({long}, {made}, null)' if long else made})"
        return f"filter({every}, y -> y is not null)" if long else every

    found = of(3) if words is None else f"concat({of(3)}, {of(1, f'x.w > {words}')}, {of(2, f'x.w + _h[k + 1].w > {words}')})"
    return hashed.select(*_KEY, F.explode(F.expr(found)).alias("w")).select(*_KEY, "w.*")


def deduplicated(docs: DataFrame, lines: str = "n_lines", lost: str = "n_lines_removed", words: int | None = PASSAGE_WORDS) -> DataFrame:
    """The columns of ``docs`` with covered lines taken out of text, and the numbers of non-blank lines and of those removed.

    Blank lines belong to no window; one goes when no line beside it stays. A
    document with fewer than three non-blank lines loses only passages of more
    than ``words`` words, or none if that is None. A null text
    stays null. Rows with the same doc_id and text are one place and keep the
    same lines; a null doc_id comes first. ``docs`` may have any columns beside
    doc_id and text; those named as ``lines`` and ``lost`` are replaced.
    """
    scratch = Scratch(docs.sparkSession, "linededup")
    places = scratch.pin(windows(docs.select("doc_id", "text"), words))
    first = places.groupBy("a", "b").agg(F.min(F.struct(*_KEY, "k")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = places.join(first, ["a", "b"]).where(~F.struct(*_KEY, "k").eqNullSafe(F.col("first")))
    covers = later.groupBy(*_KEY).agg(F.collect_set(F.struct("k", "n")).alias("_w"))
    covers = covers.select(F.col("_doc").alias("_doc2"), F.col("_hash").alias("_hash2"), F.expr(
        "array_sort(array_distinct(flatten(transform(_w, w -> sequence(w.k, w.k + w.n - 1)))))").alias("_k"))
    keyed = docs.withColumn("_doc", F.col("doc_id")).withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    met = keyed.join(covers, F.col("_hash").eqNullSafe(F.col("_hash2")) & F.col("_doc").eqNullSafe(F.col("_doc2")), "left")
    lined = _lined(met)
    # between one covered line and the next lie the lines from _filled[_k[i - 1] + 1] to before _filled[_k[i]]
    gaps = lined.withColumn("_gaps", F.expr(
        "filter(transform(sequence(0, size(_k)), i -> struct(if(i = 0, 0, _k[i - 1] + 1) as s, "
        "if(i = size(_k), size(_filled), _k[i]) as e)), g -> g.s < g.e)"))
    left = gaps.withColumn("_left", F.expr(
        "flatten(transform(_gaps, g -> slice(_lines, if(g.s = 0, 0, _filled[g.s - 1].i + 1) + 1, "
        "if(g.e = size(_filled), size(_lines), _filled[g.e].i) - if(g.s = 0, 0, _filled[g.s - 1].i + 1))))"))
    text = F.when(F.col("_k").isNull(), F.col("text")).otherwise(F.array_join("_left", "\n"))
    removed = F.expr("if(_k is null, 0, size(_filled) - aggregate(_gaps, 0, (n, g) -> n + g.e - g.s))").cast("long")
    own = [c for c in docs.columns if c not in (lines, lost)]
    return left.select(*(text.alias(c) if c == "text" else F.col(c) for c in own), F.size("_filled").cast("long").alias(lines), removed.alias(lost))
