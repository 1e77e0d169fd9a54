"""Joins of closed integer ranges.

Every row has a level that fits its width: at that level it covers one to nine
bins, or one to three where the join has equal keys as well. Two rows meet on the coarser of their levels, so a row also enters its one
or two bins on each coarser level that the other side has. A wide range is thus
cut into bins, and narrow ones are not copied for it. Rows are joined by equal
bins; a pair that shares several is kept in the bin in which the later of the
two begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import pin

_STEP = 3  # levels are apart by this many bits

OVERLAPS, CONTAINS, WITHIN, NESTED = "overlaps", "contains", "within", "nested"


def _level(lo: Column, hi: Column, spread: int) -> Column:
    """Bits of a bin such that the range covers at most 2 ** spread + 1 bins."""
    bits = F.length(F.bin(hi - lo))
    return (F.ceil(F.greatest(F.lit(0), bits - spread) / _STEP) * _STEP).cast("int")


def _placed(df: DataFrame, lo: Column, hi: Column, keys: list[str] = (), spread: int = _STEP) -> DataFrame:
    """Rows as ``_row`` with their keys, ``_lo``, ``_hi`` and ``_level``; ranges without both bounds, or empty ones, meet nothing."""
    rows = df.select(F.struct(*[c for c in df.columns if c not in keys]).alias("_row"), *keys, lo.cast("long").alias("_lo"), hi.cast("long").alias("_hi"))
    return rows.where("_lo <= _hi").withColumn("_level", _level(F.col("_lo"), F.col("_hi"), spread))


def _levels(df: DataFrame) -> list[int]:
    """Levels that occur, from the finest: at most 22."""
    return sorted(r[0] for r in df.select("_level").distinct().collect())


def _bins(rows: DataFrame, level: Column) -> DataFrame:
    """One row for each bin of ``level``."""
    bits = F.col("_at")
    first, last = (F.call_function("shiftright", F.col(c), bits) for c in ("_lo", "_hi"))
    return rows.withColumn("_at", level).withColumn("_bin", F.explode(F.sequence(first, last)))


def _renamed(df: DataFrame, side: str, keys: list[str]) -> DataFrame:
    return df.select("_at", "_bin", *keys, *[F.col(c).alias(f"{side}{c}") for c in ("_row", "_lo", "_hi")])


def _matches(kind: str) -> Column:
    outside = (F.col("l_lo") <= F.col("r_lo")) & (F.col("l_hi") >= F.col("r_hi"))
    inside = (F.col("r_lo") <= F.col("l_lo")) & (F.col("r_hi") >= F.col("l_hi"))
    meets = (F.col("l_lo") <= F.col("r_hi")) & (F.col("r_lo") <= F.col("l_hi"))
    return {OVERLAPS: meets, CONTAINS: outside, WITHIN: inside, NESTED: outside | inside}[kind]


def interval_join(left: DataFrame, right: DataFrame, left_range: tuple[Column, Column], right_range: tuple[Column, Column],
                  kind: str = OVERLAPS, on: list[tuple[Column, Column]] = ()) -> DataFrame:
    """Pairs (left, right), as structs, whose ranges overlap, contain each other, or lie within each other.

    Bounds are closed and whole numbers (days, microseconds, keys). ``on`` are
    further pairs of expressions that must be equal. Each pair comes once.
    """
    keys = [f"_key{k}" for k in range(len(on))]
    lefts = left.select("*", *[one.alias(k) for k, (one, _) in zip(keys, on)])
    rights = right.select("*", *[other.alias(k) for k, (_, other) in zip(keys, on)])
    # with keys few rows share a bin, so wider bins cost less than more copies
    spread = 1 if on else _STEP
    # each side is computed once: its levels are asked for before the join is planned
    a, b = (pin(_placed(df, *bounds, keys, spread), "ranges") for df, bounds in ((lefts, left_range), (rights, right_range)))
    levels = {"a": _levels(a), "b": _levels(b)}

    def own(rows: DataFrame, some: Column) -> DataFrame:
        return _bins(rows.where(some), F.col("_level"))

    def up(rows: DataFrame, other: str) -> DataFrame:
        above = F.filter(F.array(*[F.lit(x) for x in levels[other]]).cast("array<int>"), lambda x: x > F.col("_level"))
        return _bins(rows.withColumn("_up", F.explode(above)), F.col("_up"))

    # of the rows at their own level, only those go to a join that can meet something there
    same, above = F.col("_level").isin(levels["a"]), F.col("_level") > min(levels["a"], default=99)
    own_a = own(a, F.col("_level") >= min(levels["b"], default=99))
    meet = ["_at", "_bin", *keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return _renamed(df, name, keys)

    every_b = own(b, same).unionByName(up(b, "a"), allowMissingColumns=True)
    pairs = side(own_a, "l").join(side(every_b, "r"), meet).unionByName(side(up(a, "b"), "l").join(side(own(b, above), "r"), meet))
    first = F.call_function("shiftright", F.greatest("l_lo", "r_lo"), F.col("_at")) == F.col("_bin")
    kept = pairs.where(_matches(kind) & first)
    return kept.select(F.struct(*[f"l_row.{c}" for c in left.columns]).alias("left"), F.struct(*[f"r_row.{c}" for c in right.columns]).alias("right"))
