"""Ordered-row, hierarchy and transcript queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import hierarchy, ordered
from millrace.operators.merge import top_per_group
from registry import query, table


@query("islands_sum", """
WITH starts AS (SELECT event_id AS lo, row_number() OVER (ORDER BY event_id) AS island FROM events WHERE event_type = 'error'
                UNION ALL SELECT min(event_id) - 1, 0 FROM events)
SELECT CAST(island AS BIGINT) AS island, CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (WHERE event_type <> 'error') AS DOUBLE) AS total
FROM events ASOF JOIN starts ON event_id >= lo GROUP BY island
""")
def islands_sum(spark, d):
    is_error = F.col("event_type") == "error"
    value = F.when(~is_error, F.col("value").cast("decimal(12,2)"))
    rows = table(spark, d, "events").select("event_id", "event_type", value.alias("calories"))
    sums = ordered.island_sums(rows, "event_id", is_error, "calories")
    return sums.select("island", F.col("total").cast("double").alias("total"))


_CELLS = "(SELECT l_linenumber AS x, l_orderkey AS y, CAST(max(l_quantity) AS INTEGER) AS tree FROM lineitem GROUP BY 1, 2)"


def _cells(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("x"), F.col("l_orderkey").alias("y")).agg(
        F.max("l_quantity").cast("int").alias("tree")
    )


@query("grid_visible", f"""
WITH cells AS {_CELLS},
by_x AS (SELECT h.x, h.tree, min(c.y) AS near, max(c.y) AS far FROM (SELECT DISTINCT x, tree FROM cells) h JOIN cells c ON c.x = h.x AND c.tree >= h.tree GROUP BY ALL),
by_y AS (SELECT h.y, h.tree, min(c.x) AS near, max(c.x) AS far FROM (SELECT DISTINCT y, tree FROM cells) h JOIN cells c ON c.y = h.y AND c.tree >= h.tree GROUP BY ALL)
SELECT c.x, count(*) AS cells, count(*) FILTER (WHERE c.y IN (a.near, a.far) OR c.x IN (b.near, b.far)) AS seen,
       CAST(sum(c.y) FILTER (WHERE c.y IN (a.near, a.far) OR c.x IN (b.near, b.far)) AS BIGINT) AS seen_y
FROM cells c JOIN by_x a ON a.x = c.x AND a.tree = c.tree JOIN by_y b ON b.y = c.y AND b.tree = c.tree GROUP BY c.x
""")
def grid_visible(spark, d):
    seen = ordered.grid_visibility(_cells(spark, d))
    return seen.groupBy("x").agg(
        F.count("*").alias("cells"), F.count_if("visible").alias("seen"),
        F.sum(F.when(F.col("visible"), F.col("y"))).alias("seen_y"),
    )


@query("grid_border", f"""
SELECT m.x, count(*) AS border_cells, CAST(sum(tree) AS BIGINT) AS trees
FROM {_CELLS} m, (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM {_CELLS}) b
WHERE m.y = y0 OR m.y = y1 OR m.x = x0 OR m.x = x1 GROUP BY m.x
""")
def grid_border(spark, d):
    """Cells on the border, found with the one-row bounds of the grid."""
    cells = _cells(spark, d)
    ends = F.struct(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    edge = cells.agg(ends.alias("ends")).scalar()
    at_edge = F.col("y").isin(edge["y0"], edge["y1"]) | F.col("x").isin(edge["x0"], edge["x1"])
    return cells.where(at_edge).groupBy("x").agg(F.count("*").alias("border_cells"), F.sum("tree").alias("trees"))


_EDGES = """
(SELECT 'r' || r_regionkey AS name, NULL AS parent FROM region
 UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
 UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier
 UNION ALL SELECT 'c' || c_custkey, CASE WHEN c_custkey < 10 THEN 'n' || c_nationkey ELSE 'c' || (c_custkey // 3) END FROM customer)
"""


def _edges(spark, d):
    """Region, nation and supplier names as a tree, with a deep tree of customers below the nations."""

    def named(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    root = F.lit(None).cast("string")
    above = F.when(F.col("c_custkey") < 10, named("n", "c_nationkey")).otherwise(
        F.concat(F.lit("c"), F.floor(F.col("c_custkey") / 3).cast("bigint").cast("string"))
    )
    levels = [
        table(spark, d, "region").select(named("r", "r_regionkey").alias("name"), root.alias("parent")),
        table(spark, d, "nation").select(named("n", "n_nationkey"), named("r", "n_regionkey")),
        table(spark, d, "supplier").select(named("s", "s_suppkey"), named("n", "s_nationkey")),
        table(spark, d, "customer").select(named("c", "c_custkey"), above),
    ]
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    return out


# every name of this tree hangs below a region, by the arithmetic of the customer keys
@query("hierarchy_walk", f"SELECT DISTINCT name, parent FROM {_EDGES}")
def hierarchy_walk(spark, d):
    return hierarchy.walk_hierarchy(_edges(spark, d), "name", "parent").select("name", "parent")


@query("hierarchy_paths", """
WITH nations AS (SELECT n_nationkey AS n, '/r' || n_regionkey || '/n' || n_nationkey AS below FROM nation),
ancestors AS (SELECT c_custkey AS c, k, CAST(floor(c_custkey / pow(3, k)) AS BIGINT) AS a FROM customer, range(1, 40) r(k)
              WHERE floor(c_custkey / pow(3, k - 1)) >= 10),
lines AS (SELECT c, arg_max(a, k) AS top, string_agg('/c' || a, '' ORDER BY k DESC) AS names FROM ancestors GROUP BY c)
SELECT 'r' || r_regionkey AS name, '' AS path FROM region
UNION ALL SELECT 'n' || n_nationkey, '/r' || n_regionkey FROM nation
UNION ALL SELECT 's' || s_suppkey, below FROM supplier JOIN nations ON n = s_nationkey
UNION ALL SELECT 'c' || c_custkey, below FROM customer JOIN nations ON n = c_nationkey WHERE c_custkey < 10
UNION ALL SELECT 'c' || c, below || names FROM lines JOIN customer ON c_custkey = top JOIN nations ON n = c_nationkey
""")
def hierarchy_paths(spark, d):
    return hierarchy.hierarchy_paths(_edges(spark, d), "name", "parent").select("name", "path")


def _transcripts(spark, d):
    k = F.get_json_object("props", "$.k")
    body = F.array(
        F.concat(F.lit("$ cd "), "event_type"), F.lit("$ ls"),
        F.concat(F.round(F.col("value") * 100).cast("int").cast("string"), F.lit(" f"), "event_id", F.lit(".txt")),
        F.concat(F.lit("dir "), k), F.concat(F.lit("$ cd d"), k),
        F.concat((F.col("event_id") % 1000).cast("string"), F.lit(" g.lst")), F.lit("$ cd .."), F.lit("$ cd .."),
    )
    events = table(spark, d, "events", "user_id", "event_id", "event_type", "value", "props")
    lines = events.select("user_id", "event_id", F.posexplode(body).alias("j", "line"))
    lines = lines.select(F.col("user_id").alias("session"), (F.col("event_id") * 10 + F.col("j") + 1).alias("id"), "line")
    heads = events.select(F.col("user_id").alias("session")).distinct()
    return lines.unionByName(heads.select("session", F.lit(-1).cast("bigint").alias("id"), F.lit("$ cd /").alias("line")))


# each event lists one file in the directory of its type and one in a directory below it
_SIZES = r"""
WITH files AS (
  SELECT user_id AS session, event_type AS t, 'd' || json_extract_string(props, '$.k') AS k, event_id % 1000 AS inner_bytes,
         CAST(regexp_extract(CAST(CAST(value * 100 AS INTEGER) AS VARCHAR), '[0-9]+') AS BIGINT) AS outer_bytes FROM events),
sizes AS (
  SELECT session, dir, sum(size) AS size FROM (
    SELECT session, '/' AS dir, inner_bytes + outer_bytes AS size FROM files
    UNION ALL SELECT session, '/>' || t, inner_bytes + outer_bytes FROM files
    UNION ALL SELECT session, '/>' || t || '>' || k, inner_bytes FROM files) GROUP BY ALL)
"""


@query("dir_sizes", _SIZES + "SELECT session, dir, CAST(size AS BIGINT) AS size FROM sizes")
def dir_sizes(spark, d):
    direct = hierarchy.replay_transcripts(_transcripts(spark, d), "session", "id", "line")
    totals = hierarchy.directory_totals(direct, ["session"])
    return totals.select("session", F.array_join("dir", ">").alias("dir"), "size")


@query("dir_sizes_small", _SIZES + """
SELECT session, CAST(sum(size) AS BIGINT) AS space_freed FROM sizes WHERE size < 100000 GROUP BY session
""")
def dir_sizes_small(spark, d):
    direct = hierarchy.replay_transcripts(_transcripts(spark, d), "session", "id", "line")
    totals = hierarchy.directory_totals(direct, ["session"])
    return totals.where("size < 100000").groupBy("session").agg(F.sum("size").alias("space_freed"))


@query("position_in_group", """
SELECT o_orderkey, o_custkey, place FROM (
  SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders)
WHERE place <= 3
""")
def position_in_group(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    top = top_per_group(rows, ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"], 3, rank="place")
    return top.select("o_orderkey", "o_custkey", "place")


@query("page_of_rows", """
SELECT o_orderkey, page FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) // 100 AS page FROM orders)
""")
def page_of_rows(spark, d):
    """Every page of the price order at once (paging without an offset per page)."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    numbered = ordered.global_ordinal(rows, [F.desc("o_totalprice"), "o_orderkey"], "n")
    return numbered.select("o_orderkey", F.floor((F.col("n") - 1) / 100).alias("page"))


@query("running_totals", """
SELECT event_id, CAST(sum(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY event_id) AS DOUBLE) AS so_far
FROM events
""")
def running_totals(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "value")
    out = ordered.running_sum(rows, ["user_id"], ["event_id"], F.col("value").cast("decimal(12,2)"), "so_far")
    return out.select("event_id", F.col("so_far").cast("double").alias("so_far"))
