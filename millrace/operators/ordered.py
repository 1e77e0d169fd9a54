"""Ordered computations that no single task has to hold.

A window partitioned only by a key runs each key in one task, and a window
without a key runs everything in one task. The operators here work in two
levels instead: the rows are range-sorted by key and order and pinned, the
parts of that sort are chunks, and rows are windowed inside ``(key, chunk)``.
Only a key that does not fit one part lies in several. Every chunk starts from
a *seed row* that carries what came before it in its key; seeds come from one
row per key and chunk. The plan is the same for every size of table; how many
parts a sort has follows from its bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import pin

_POSITION_BITS = 33  # row position inside its part, as laid out by monotonically_increasing_id
#: Bytes of a part of a sort, and the most parts of one.
PART_BYTES, MOST_PARTS = 64 << 20, 100_000


def parts_of(df: DataFrame) -> int:
    """Parts of a sort, by the bytes that Spark expects of ``df`` (of stored tables and ``measured`` rows, by their files); at least one for each core."""
    expected = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(2, df.sparkSession.sparkContext.defaultParallelism, min(MOST_PARTS, -(-expected // PART_BYTES)))


def _known_size(plan) -> bool:
    """Whether a plan only picks rows and columns of stored or listed tables, so that Spark can tell its bytes."""
    if plan.nodeName() in ("Project", "Filter", "Union"):
        children = plan.children()
        return all(_known_size(children.apply(i)) for i in range(children.size()))
    return plan.nodeName() in ("LogicalRelation", "LocalRelation", "Range")


def measured(df: DataFrame) -> DataFrame:
    """``df`` with bytes that are known.

    What Spark expects of a join is the product of its sides, of exploded rows
    too little. Such rows are written first, and count by their files; they are
    also computed once, where a range sort would compute them for its sample too.
    """
    return df if _known_size(df._jdf.queryExecution().optimizedPlan()) else pin(df, "measured")


def chunked(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with a ``_chunk`` column that does not decrease along ``keys`` and ``order``."""
    df = measured(df)
    return pin_sorted(df, [*keys, *order], parts_of(df)).withColumnRenamed("_part", "_chunk").drop("_pos")


_FAN = 512  # chunks of a tile; its square is more than MOST_PARTS
_KINDS = {"sum": F.sum, "max": F.max, "last": F.last}


def _both(kind: str, near: Column, far: Column) -> Column:
    """What a chunk gets from its own tile and from the tiles before it."""
    if kind == "last":
        return F.coalesce(near, far)
    return F.greatest(near, far) if kind == "max" else F.when(near.isNull(), far).when(far.isNull(), near).otherwise(near + far)


def _before(ends: DataFrame, keys: list[str], kinds: dict[str, str]) -> DataFrame:
    """``ends`` (a row for each key and chunk) with the sum, maximum or last of its values over the earlier chunks of the key.

    Without keys the chunks form a tree of two levels: tiles of ``_FAN``
    chunks, and the tiles in their order.
    """
    def scanned(df: DataFrame, group: list[str], order: str) -> DataFrame:
        earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({n: _KINDS[kind](n).over(earlier) for n, kind in kinds.items()})

    if keys:
        return scanned(ends, keys, "_chunk")
    tiled = ends.withColumn("_tile", F.floor(F.col("_chunk") / _FAN))
    whole = [(F.max_by(n, "_chunk") if kind == "last" else _KINDS[kind](n)).alias(n) for n, kind in kinds.items()]
    tiles = tiled.groupBy("_tile").agg(*whole).withColumn("_top", F.floor(F.col("_tile") / _FAN))
    far = scanned(tiles, ["_top"], "_tile").select("_tile", *[F.col(n).alias(f"_far_{n}") for n in kinds])
    near = scanned(tiled, ["_tile"], "_chunk")
    joined = near.join(far, "_tile")
    return joined.select("_chunk", *[_both(kind, F.col(n), F.col(f"_far_{n}")).cast(near.schema[n].dataType).alias(n) for n, kind in kinds.items()])


def pin_sorted(df: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """Globally sorted rows, written once, with their part and position.

    One range shuffle; the written table fixes part numbers, so later jobs (and
    retries after lost executors) see the same numbers. Adds ``_part`` and
    ``_pos`` (zero-based position inside the part). ``parts`` sets their number;
    without it the session's shuffle partitions apply.
    """
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order) if parts else df.orderBy(*order)
    placed = pin(placed.withColumn("_row", F.monotonically_increasing_id()))
    row = F.col("_row")
    return placed.select(
        *df.columns,
        F.shiftright(row, _POSITION_BITS).cast("int").alias("_part"),
        row.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    )


def global_ordinal(df: DataFrame, order: list, name: str = "ordinal") -> DataFrame:
    """Dense 1..n over the whole table in the given (total) order."""
    df = measured(df)
    placed = pin_sorted(df, order, parts_of(df))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = _before(counts.withColumnRenamed("_part", "_chunk"), [], {"_rows": "sum"})
    offsets = earlier.select(F.col("_chunk").alias("_part"), F.coalesce("_rows", F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_part")  # one row per part
    return numbered.withColumn(name, F.col("_before") + F.col("_pos") + 1).select(*df.columns, name)


def with_previous(df: DataFrame, keys: list[str], order: str, values: list[str], prefix: str = "prev_") -> DataFrame:
    """``lag`` of each value along ``order`` inside ``keys``; NULL on first rows.

    ``order`` must be unique inside a key.
    """
    tagged = chunked(df, keys, [order]).withColumn("_real", F.lit(1))
    last = tagged.groupBy(*keys, "_chunk").agg(F.max_by(F.struct(*values), order).alias("_last"))
    seeds = _before(last, keys, {"_last": "last"})
    seeds = seeds.where(F.col("_last").isNotNull()).select(*keys, "_chunk", "_last.*", F.lit(0).alias("_real"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_real", order)
    rows = tagged.unionByName(seeds, allowMissingColumns=True)
    lagged = rows.select("*", *[F.lag(v).over(inside).alias(prefix + v) for v in values])
    return lagged.where("_real = 1").drop("_chunk", "_real")


def running_sums(df: DataFrame, keys: list[str], order: list[str], amounts: dict[str, Column]) -> DataFrame:
    """Per name, the sum of its amount from the first row of the key up to and with each row."""
    tagged = chunked(df.select("*", *[a.alias(n) for n, a in amounts.items()]), keys, order).withColumn("_real", F.lit(1))
    totals = tagged.groupBy(*keys, "_chunk").agg(*[F.sum(n).alias(n) for n in amounts], F.lit(1).cast("long").alias("_n"))
    seeds = _before(totals, keys, {**dict.fromkeys(amounts, "sum"), "_n": "sum"}).where("_n > 0").drop("_n").withColumn("_real", F.lit(0))
    rows = tagged.unionByName(seeds, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_real", *order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({n: F.sum(n).over(upto) for n in amounts}).where("_real = 1").drop("_chunk", "_real")


def running_sum(df: DataFrame, keys: list[str], order: list[str], amount: Column, name: str) -> DataFrame:
    return running_sums(df, keys, order, {name: amount})


def running_max(df: DataFrame, keys: list[str], order: list[str], value: str | Column, name: str) -> DataFrame:
    """Largest non-NULL ``value`` up to and with each row of the key."""
    source = F.col(value) if isinstance(value, str) else value
    tagged = chunked(df.select("*", source.alias(name)), keys, order).withColumn("_real", F.lit(1))
    tops = tagged.groupBy(*keys, "_chunk").agg(F.max(name).alias(name))
    seeds = _before(tops, keys, {name: "max"})
    rows = tagged.unionByName(seeds.where(F.col(name).isNotNull()).withColumn("_real", F.lit(0)), allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_real", *order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.max(name).over(upto)).where("_real = 1").drop("_chunk", "_real")


def asof_latest(left: DataFrame, right: DataFrame, keys: list[str], time: str, values: list[str], prefix: str = "last_") -> DataFrame:
    """Each left row with the values of the latest right row of its key at or before its time.

    Both sides become one ordered stream per key; the latest right row is a
    running maximum over ``(time, values)``, so nothing is joined by inequality.
    """
    carried = F.struct(F.col(time), *values)
    stream = left.withColumn("_turn", F.lit(1)).unionByName(
        right.select(*keys, time, carried.alias("_row"), F.lit(0).alias("_turn")), allowMissingColumns=True
    )
    held = running_max(stream, keys, [time, "_turn"], "_row", "_latest").where("_turn = 1")
    return held.select(*left.columns, *[F.col(f"_latest.{c}").alias(prefix + c) for c in [time, *values]])


def maxima_around(df: DataFrame, line: str, place: str, value: str, tile: int, before: str, after: str,
                  plain: DataFrame | None = None) -> DataFrame:
    """Largest value strictly before and strictly after each place of a line.

    Each line is cut into tiles of ``tile`` places; a tile gets one seed row in
    front and one behind, so both directions share one shuffle. ``plain`` holds the
    same cells without derived columns, when that is cheaper for the tile maxima.
    """
    chunk = F.floor(F.col(place) / tile)
    tagged = df.withColumn("_chunk", chunk).withColumn("_side", F.lit(0))
    cells = df if plain is None else plain
    tops = cells.groupBy(line, chunk.alias("_chunk")).agg(F.max(value).alias("_top"))
    along = Window.partitionBy(line).orderBy("_chunk")
    ahead = F.max("_top").over(along.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.max("_top").over(along.rowsBetween(1, Window.unboundedFollowing))
    sides = F.array(
        F.struct(F.lit(-1).alias("_side"), ahead.alias("_seed")),
        F.struct(F.lit(1).alias("_side"), behind.alias("_seed")),
    )
    seeds = tops.select(line, "_chunk", sides.alias("_sides")).select(line, "_chunk", F.inline("_sides"))
    seeds = seeds.where(F.col("_seed").isNotNull()).withColumnRenamed("_seed", value)
    rows = tagged.unionByName(seeds, allowMissingColumns=True)
    inside = Window.partitionBy(line, "_chunk").orderBy("_side", place)
    return rows.select(
        "*",
        F.max(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)).alias(before),
        F.max(value).over(inside.rowsBetween(1, Window.unboundedFollowing)).alias(after),
    ).where("_side = 0").drop("_chunk", "_side")


def grid_visibility(cells: DataFrame, x: str = "x", y: str = "y", value: str = "tree",
                    tile: int = 4096) -> DataFrame:
    """Cells with ``visible``: higher than all cells on one of its four sides. The cells are computed once."""
    cells = pin(cells, "cells")
    columns = maxima_around(cells, x, y, value, tile, "_north", "_south")
    both = maxima_around(columns, y, x, value, tile, "_west", "_east", plain=cells)
    height = F.col(value)
    seen = None
    for side in ("_north", "_south", "_west", "_east"):
        free = height > F.coalesce(F.col(side), F.lit(-1))
        seen = free if seen is None else seen | free
    return both.select(*cells.columns, seen.alias("visible"))


def island_sums(df: DataFrame, order: str, separator: Column, value: str) -> DataFrame:
    """Sum ``value`` per island, where each separator row opens the next island."""
    flagged = running_sum(df, [], [order], F.when(separator, 1).otherwise(0), "island")
    return flagged.groupBy("island").agg(F.sum(value).alias("total"))


def chunked_pages(df: DataFrame, order: list, page_rows: int, columns: list[str]) -> DataFrame:
    """Fixed-size pages of the ordered table, each column as one array per page."""
    numbered = global_ordinal(df, order, "_n").withColumn("page", F.floor((F.col("_n") - 1) / page_rows))
    packed = F.array_sort(F.collect_list(F.struct("_n", *columns)))
    pages = numbered.groupBy("page").agg(packed.alias("_rows"))
    return pages.select("page", *[F.col(f"_rows.{c}").alias(c) for c in columns])
