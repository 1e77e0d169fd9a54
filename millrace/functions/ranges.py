"""Closed ranges as ``struct<lo, hi>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def make(lo: Column, hi: Column) -> Column:
    """Range from two bounds; an error when ``lo > hi``."""
    checked = F.assert_true((lo <= hi) | lo.isNull() | hi.isNull(), F.lit("range lower bound above upper bound"))
    return F.when(checked.isNull(), F.struct(lo.alias("lo"), hi.alias("hi")))


def parse(text: Column, delimiter: str = "-") -> Column:
    """``'2-8'`` -> ``{lo: 2, hi: 8}``."""
    lo = F.split_part(text, F.lit(delimiter), F.lit(1)).cast("int")
    hi = F.split_part(text, F.lit(delimiter), F.lit(2)).cast("int")
    return make(lo, hi)


def lower(rng: Column) -> Column:
    return rng["lo"]


def upper(rng: Column) -> Column:
    return rng["hi"]


def contains(outer: Column, inner: Column) -> Column:
    return (outer["lo"] <= inner["lo"]) & (outer["hi"] >= inner["hi"])


def nested(left: Column, right: Column) -> Column:
    """True when one of the two ranges lies fully inside the other."""
    return contains(left, right) | contains(right, left)


def values(rng: Column) -> Column:
    """All integers of the range as an array (for small ranges)."""
    return F.sequence(rng["lo"], rng["hi"])
