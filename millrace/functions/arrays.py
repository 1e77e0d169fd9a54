"""Array helpers with one-based, out-of-range-is-NULL rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def element(array: Column, index) -> Column:
    """``array[index]``, one-based; NULL when the index is outside the array."""
    i = _col(index)
    return F.when(i >= 1, F.get(array, i - 1))


def between(array: Column, lo=1, hi=None) -> Column:
    """``array[lo:hi]`` with inclusive one-based bounds; open bounds allowed."""
    size = F.size(array)
    start = F.greatest(_col(lo), F.lit(1))
    stop = size if hi is None else F.least(_col(hi), size)
    return F.slice(array, start, F.greatest(F.lit(0), stop - start + 1))


def drop_last(array: Column, n: int = 1) -> Column:
    return between(array, 1, F.size(array) - n)


def append(array: Column, value) -> Column:
    return F.array_append(array, _col(value))


def length(array: Column) -> Column:
    """Element count; NULL for an empty or NULL array."""
    return F.when(F.size(array) > 0, F.size(array))


def cardinality(array: Column) -> Column:
    """Element count; 0 for an empty array, NULL for a NULL array."""
    return F.when(array.isNotNull(), F.size(array))


def has(array: Column, value) -> Column:
    return F.array_contains(array, _col(value))


def overlaps(left: Column, right: Column) -> Column:
    return F.arrays_overlap(left, right)


def contains_all(left: Column, right: Column) -> Column:
    """True when every element of ``right`` occurs in ``left`` (set rules)."""
    return F.size(F.array_except(right, left)) == 0


def contained_by(left: Column, right: Column) -> Column:
    return contains_all(right, left)


def replace_at(array: Column, index: int, value) -> Column:
    """Copy of ``array`` with the one-based element ``index`` replaced."""
    new = _col(value)
    return F.transform(array, lambda x, i: F.when(i == index - 1, new).otherwise(x))


def is_rectangular(matrix: Column) -> Column:
    """Whether the rows of a two-dimensional array have one length."""
    return F.size(F.array_distinct(F.transform(matrix, lambda row: F.size(row)))) <= 1


def rectangular(matrix: Column) -> Column:
    """The two-dimensional array itself, or an error when its rows differ in length."""
    message = F.lit("multidimensional arrays must have rows of one length")
    return F.when(F.assert_true(is_rectangular(matrix), message).isNull(), matrix)


def unnest(df: DataFrame, array: str | Column, value: str, ordinal: str | None = None) -> DataFrame:
    """One row per element next to the other columns, with its one-based place."""
    source = F.col(array) if isinstance(array, str) else array
    if ordinal is None:
        return df.select("*", F.explode(source).alias(value))
    out = df.select("*", F.posexplode(source).alias(ordinal, value))
    return out.withColumn(ordinal, (F.col(ordinal) + 1).cast("bigint"))


def zip_rows(df: DataFrame, arrays: dict[str, Column], keep: list[str] = ()) -> DataFrame:
    """Arrays side by side as rows; shorter arrays are padded with NULL."""
    named = [value.alias(name) for name, value in arrays.items()]
    zipped = df.select(*keep, *named).select(*keep, F.arrays_zip(*arrays).alias("_zipped"))
    return zipped.select(*keep, F.inline("_zipped"))


def ordered_array_agg(value: Column, order: list[str], where: Column | None = None) -> Column:
    """Aggregate to an array in the given order, NULLs of the order last; duplicates and NULL values stay.

    ``where`` leaves rows out; no rows give NULL. A group lies in one task, so
    groups must be bounded; ``chunked_pages`` cuts larger ones.
    """
    keys = [c for k, name in enumerate(order) for c in (F.col(name).isNull().alias(f"n{k}"), F.col(name).alias(f"o{k}"))]
    entry = F.struct(*keys, value.alias("v"))
    found = F.array_sort(F.collect_list(entry if where is None else F.when(where, entry)))
    return F.when(F.size(found) > 0, F.transform(found, lambda e: e["v"]))


def ordered_text_agg(value: Column, separator: str, order: list[str], where: Column | None = None) -> Column:
    """Aggregate to one text in the given order; duplicates stay, NULL values are left out."""
    found = F.filter(ordered_array_agg(value, order, where), lambda v: v.isNotNull())
    return F.when(F.size(found) > 0, F.array_join(found.cast("array<string>"), separator))
