"""Tree walks over adjacency lists, and replay of directory transcripts."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from millrace.functions import text as tx
from millrace.operators.ordered import _POSITION_BITS, _before, measured, parts_of
from millrace.session import pin

# tasks need not find this module on their own path: the code travels with them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMPACT_ROUNDS = 16  # visited sets are rewritten as one after so many rounds


def walk_hierarchy(edges: DataFrame, node: str, parent: str, depth: str = "depth") -> DataFrame:
    """All rows reachable from the roots (rows without parent), each once.

    The loop only follows names: a round joins the (node, parent) pairs with the
    names found in the round before and keeps the names not seen yet, so every
    name is expanded once and cycles end. The full rows are joined once, at the
    end. Rounds are pinned in the shared folder: the plan does not grow with the
    depth, a lost executor does not restart the walk, and Spark picks the join of
    a round by the written size of its names.
    """
    rows = edges.distinct()
    pairs = pin(edges.select(F.col(node).alias("_node"), F.col(parent).alias("_up")).distinct())
    links = pairs.where("_up IS NOT NULL AND _node IS NOT NULL")
    fresh = pin(pairs.where("_up IS NULL AND _node IS NOT NULL").select(F.col("_node").alias("_name")).distinct())
    seen = fresh.withColumn("_at", F.lit(0))
    rounds = 0
    while not fresh.isEmpty():
        rounds += 1
        below = links.join(fresh, F.col("_up") == F.col("_name"), "left_semi")
        names = below.select(F.col("_node").alias("_name")).distinct()
        fresh = pin(names.join(seen.select("_name"), "_name", "left_anti"))
        seen = seen.unionByName(fresh.withColumn("_at", F.lit(rounds)))
        if rounds % COMPACT_ROUNDS == 0:
            seen = pin(seen)
    roots = rows.where(F.col(parent).isNull()).withColumn(depth, F.lit(0))
    reached = rows.join(seen, F.col(parent) == F.col("_name")).withColumn(depth, F.col("_at") + 1)
    return roots.unionByName(reached.select(*rows.columns, depth))


def hierarchy_paths(edges: DataFrame, node: str, parent: str, path: str = "path", sep: str = "/") -> DataFrame:
    """Rows with the path above them: '' for roots, parent path + sep + parent below.

    A node under several parents gets one row per path. Every round doubles how
    far up a row has looked, so depth costs rounds by its logarithm and has no
    limit. A path longer than there are nodes comes back to a node and raises.
    """
    rows = pin(edges.distinct())
    nodes = rows.select(node).distinct().count()
    suffix = F.when(F.col(parent).isNull(), "").otherwise(F.concat(F.lit(sep), F.col(parent)))
    state = pin(rows.select("*", F.col(parent).alias("_top"), suffix.alias(path), F.when(F.col(parent).isNull(), 0).otherwise(1).cast("bigint").alias("_steps")))
    reach = 1
    while reach <= 2 * nodes and not (ahead := state.where("_top IS NOT NULL")).isEmpty():
        jumps = state.select(F.col(node).alias("_name"), F.col("_top").alias("_next"), F.col(path).alias("_above"), F.col("_steps").alias("_more")).distinct()
        met = ahead.join(jumps, F.col("_top") == F.col("_name"))
        met = met.select(*rows.columns, F.col("_next").alias("_top"), F.concat("_above", path).alias(path), (F.col("_steps") + F.col("_more")).alias("_steps"))
        state = pin(state.where("_top IS NULL").unionByName(met))
        reach *= 2
    done = state.where("_top IS NULL")
    if (again := done.where(F.col("_steps") >= nodes).first()) is not None:
        raise RecursionError(f"cycle above {again[node]}")
    return done.drop("_top", "_steps")


def replay_transcripts(lines: DataFrame, session: str, order: str, line: str) -> DataFrame:
    """Directories of shell transcripts with the file bytes directly inside.

    Returns ``session, dir (array), size``; a directory that was entered more
    than once has one row per entry. The lines are range-sorted once, and each
    part of the sort is replayed by itself: paths begin where the part does. Only
    the first session of a part may go on from an earlier one, and only the last
    may go on in a later one, so what is left to join are a few rows per part:
    directories that stay open, and those around its beginning that it asks for.
    Leaving an empty path is an error.
    """
    target = F.regexp_extract(F.col(line), tx.CHANGE_DIR_PATTERN, 1)
    is_cd = F.col(line).rlike(tx.CHANGE_DIR_PATTERN)
    is_file = F.col(line).rlike(tx.FILE_PATTERN)
    size = F.when(is_file, F.regexp_extract(F.col(line), tx.FILE_PATTERN, 1).cast("bigint"))
    moves = lines.where(is_cd | is_file).select(
        F.col(session).alias("_s"), F.col(order).cast("bigint").alias("_id"),
        F.when(is_cd, target).alias("_dir"), size.alias("_size"),
    )
    moves = measured(moves)
    placed = moves.repartitionByRange(parts_of(moves), "_s", "_id").sortWithinPartitions("_s", "_id")
    schema = StructType([placed.schema["_s"], *(StructField(n, LongType()) for n in _REPLAYED), StructField("_path", ArrayType(StringType()))])
    replayed = pin(placed.mapInArrow(_replay_part, schema))
    done = replayed.where("_path IS NOT NULL AND _enter IS NULL")
    opened, paths, asked = _seams(pin(replayed.where("_path IS NULL OR _enter IS NOT NULL")))

    inside = opened.select("_enter", "_size").unionByName(asked.select(F.col("_holder").alias("_enter"), "_size"))
    inside = inside.where("_enter IS NOT NULL").groupBy("_enter").agg(F.sum("_size").alias("_size"))
    left = opened.drop("_size", "_path").join(paths, "_enter").join(inside, "_enter")
    # pinned, because its file size lets Spark broadcast it
    above = asked.select("_run", "_up", "_holder").join(paths.toDF("_holder", "_above"), "_holder")
    above = pin(above.select("_run", "_up", "_above"))
    within = done.where("_up IS NOT NULL").join(above, ["_run", "_up"], "left")
    within = within.withColumn("_path", F.concat(F.coalesce("_above", F.array().cast("array<string>")), "_path"))
    out = [df.select(F.col("_s").alias(session), F.col("_path").alias("dir"), F.col("_size").alias("size"))
           for df in (done.where("_up IS NULL"), within, left)]
    return out[0].unionByName(out[1]).unionByName(out[2])


#: Numbers of a replayed row. Closed directories: ``_size`` and the path inside the part, ``_up`` levels above where the part
#: began if that may lie in another part. Left open: ``_enter`` and ``_parent``, ``_rel`` levels above ``_up``. Asked for: ``_up``,
#: with the bytes listed there; the first of them (``_up`` 0) has the levels that the run adds as ``_net``.
_REPLAYED = ("_run", "_up", "_rel", "_net", "_enter", "_parent", "_size")
_ROWS_OUT, _NAMES_OUT = 10_000, 200_000  # rows, and names in their paths, that a task gives on together


def _replay_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replay one part of the sorted moves with a stack of the directories entered in it."""
    begin = TaskContext.get().partitionId() << _POSITION_BITS
    run, entered, key, kind = begin, begin, None, None
    names, sizes, enters = [], [], []  # the stack
    outer: list[int | None] = [None]  # bytes listed in the directories around the beginning; the last is the present one
    rows, held = [], 0

    def leave():
        """Give the top of the stack on; whether it is time to write."""
        nonlocal held
        up = len(outer) - 1 if run == begin and begin else None
        rows.append((key, run, up, None, None, None, None, sizes.pop(), names.copy()))
        enters.pop()
        held += len(names)
        names.pop()
        return len(rows) >= _ROWS_OUT or held >= _NAMES_OUT

    def written():
        nonlocal held
        types = [kind, *[pa.int64()] * len(_REPLAYED), pa.list_(pa.string())]
        columns = [pa.array(column, of) for column, of in zip(zip(*rows), types)]
        rows.clear()
        held = 0
        return pa.RecordBatch.from_arrays(columns, names=["_s", *_REPLAYED, "_path"])

    def seams(last):
        """What the run asks for, and what it leaves open to later parts."""
        if last or run == begin or len(outer) > 1:
            net, up = len(names) - len(outer) + 1, len(outer) - 1
            rows.extend((key, run, k, 0, None if k else net, None, None, size, None) for k, size in enumerate(outer))
            if last:
                stack = enumerate(zip(enters, [None, *enters], names, sizes), 1)
                rows.extend((key, run, up, rel, None, enter, parent, size, [name]) for rel, (enter, parent, name, size) in stack)

    for batch in batches:
        sessions, dirs = (batch.column(name).dictionary_encode("encode") for name in ("_s", "_dir"))
        keys, known = sessions.dictionary.to_pylist(), dirs.dictionary.to_pylist()
        listed = pc.fill_null(batch.column("_size"), -1).to_numpy().tolist()
        at = None
        for code, name, size in zip(sessions.indices.to_numpy().tolist(), map(known.__getitem__, dirs.indices.to_numpy().tolist()), listed):
            if code != at:
                at, after = code, keys[code]
                if kind is None:
                    kind, key = batch.schema.field("_s").type, after
                elif not (after == key or (after != after and key != key)):
                    seams(last=False)
                    while names:
                        if leave():
                            yield written()
                    run, key, outer = run + 1, after, [None]
            if name == "..":
                if not names:
                    outer.append(None)
                elif leave():
                    yield written()
            elif name is not None:
                entered += 1
                names.append(name)
                sizes.append(None)
                enters.append(entered)
            if size >= 0:
                around = sizes if names else outer
                around[-1] = size + (around[-1] or 0)
    if kind is not None:
        seams(last=True)
        yield written()


def _seams(seams: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Directories left open by parts, the paths of these, and what parts ask for with the open directory that holds it."""
    ends = seams.where("_net IS NOT NULL").select("_s", F.col("_run").alias("_chunk"), "_net")
    bases = _before(ends, ["_s"], {"_net": "sum"}).select(F.col("_chunk").alias("_run"), F.coalesce("_net", F.lit(0)).alias("_base"))
    level = F.col("_base") - F.col("_up") + F.col("_rel")
    checked = F.assert_true(level >= 0, F.lit("cannot leave an empty path"))
    earlier = Window.partitionBy("_s", "_level").orderBy("_run").rangeBetween(Window.unboundedPreceding, -1)
    placed = seams.join(bases, "_run").withColumn("_level", F.when(checked.isNull(), level))
    placed = pin(placed.withColumn("_holder", F.max("_enter").over(earlier)).drop("_base", "_rel", "_net"))
    asked, opened = placed.where("_enter IS NULL"), placed.where("_enter IS NOT NULL")
    holders = asked.select("_run", "_up", F.col("_holder").alias("_around"))
    entered = opened.join(holders, ["_run", "_up"]).select(
        "_enter", "_level", F.coalesce("_parent", "_around").alias("_parent"), F.element_at("_path", 1).alias("_dir"))
    return opened, _enter_paths(entered), asked


def _enter_paths(entered: DataFrame) -> DataFrame:
    """Full path of every entered directory; each round doubles how far up a row has looked."""
    deepest = entered.agg(F.max("_level")).first()[0] or 0
    here = pin(entered.select("_enter", "_parent", F.array("_dir").alias("_path")))
    reach = 1
    while reach < deepest:
        above = here.select(F.col("_enter").alias("_top"), F.col("_parent").alias("_next"), F.col("_path").alias("_above"))
        met = here.join(above.withColumnRenamed("_top", "_parent"), "_parent", "left")
        here = pin(met.select("_enter", F.col("_next").alias("_parent"), F.concat(F.coalesce("_above", F.array().cast("array<string>")), "_path").alias("_path")))
        reach *= 2
    return here.select("_enter", "_path")


def directory_totals(direct: DataFrame, keys: list[str], path: str = "dir", size: str = "size") -> DataFrame:
    """Bytes per directory with everything below it.

    Sizes are first added up per path, then each path is counted for all its
    prefixes; no prefix comparison between rows is needed.
    """
    per_path = direct.groupBy(*keys, path).agg(F.sum(size).alias(size))
    ends = F.sequence(F.lit(1), F.size(path))
    prefixes = F.transform(ends, lambda i: F.slice(F.col(path), F.lit(1), i))
    spread = per_path.select(*keys, F.explode(prefixes).alias(path), size)
    return spread.groupBy(*keys, path).agg(F.sum(size).alias(size))


