"""Text, range and document-format queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates, docs, ranges
from millrace.functions import text as tx
from millrace.operators.ordered import global_ordinal
from millrace.plans import texts
from millrace.session import fresh_path
from millrace.sources import files
from registry import query, table


@query("text_lines", r"""
SELECT doc_id, n AS line_no, parts[n] AS line
FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS n
      FROM (SELECT doc_id, string_split_regex(text, '\r?\n') AS parts FROM documents))
""")
def text_lines(spark, d):
    return texts.text_rows(table(spark, d, "documents").select("doc_id", "text"), "text").drop("text")


@query("text_lines_loaded", r"""
SELECT CAST(len(line) AS INTEGER) AS size, count(*) AS lines FROM (
  SELECT unnest(string_split_regex(text, '\r?\n')) AS line FROM documents) WHERE line <> '' GROUP BY 1
""")
def text_lines_loaded(spark, d):
    path = fresh_path(spark, "lines")
    rows = texts.text_rows(table(spark, d, "documents").select("doc_id", "text"), "text")
    rows.select("line").write.text(path)
    back = files.read_lines(spark, path).where("line IS NOT NULL")
    return back.groupBy(F.length("line").alias("size")).agg(F.count("id").alias("lines"))


@query("hand_cards", """
SELECT hand, bid, substr(cards, p, 1) AS card, p AS position
FROM (SELECT o_orderkey AS hand, upper(substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 5)) AS cards,
             CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS bid,
             unnest(generate_series(1, 5)) AS p FROM orders)
""")
def hand_cards(spark, d):
    digits = F.upper(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 5))
    line = F.concat(digits, F.lit(" "), F.floor("o_totalprice").cast("bigint").cast("string"))
    hands = table(spark, d, "orders").select(F.col("o_orderkey").alias("hand"), line.alias("lines"))
    return texts.hand_cards(hands)


# Hex digits drawn as guess tiles.
_HEX, _TILES = "0123456789abcdef", "🟩🟩🟩🟩🟨🟨🟨🟨⬜⬜⬜⬜⬛⬛⬛⬛"


@query("wordle_score", f"""
WITH tiles AS (SELECT o_orderkey, translate(md5(CAST(o_orderkey AS VARCHAR)), '{_HEX}', '{_TILES}') AS t FROM orders),
lines AS (SELECT o_orderkey, k AS guess_num, substr(t, 5 * k - 4, 5) AS g FROM tiles, range(1, 4) r(k))
SELECT o_orderkey, guess_num, length(g) - length(replace(g, '🟩', '')) AS c_correct,
       length(g) - length(replace(g, '🟨', '')) AS c_partial,
       length(g) - length(replace(replace(g, '⬛', ''), '⬜', '')) AS c_incorrect
FROM lines
""")
def wordle_score(spark, d):
    tiles = F.translate(F.md5(F.col("o_orderkey").cast("string")), _HEX, _TILES)
    rows = [F.substring(tiles, start, 5) for start in (1, 6, 11)]
    head = F.concat(F.lit("Game "), F.col("o_orderkey").cast("string"), F.lit(" 3/6*"))
    body = F.concat_ws("\n", head, *rows)
    return texts.guess_scores(table(spark, d, "orders", "o_orderkey").select("o_orderkey", body.alias("body")), "body")


@query("rucksack_priority", f"""
WITH sacks AS (SELECT doc_id, text, len(text) // 2 AS half FROM documents),
items AS (
  SELECT doc_id, unnest(list_intersect(list_distinct(string_split(substr(text, 1, half), '')),
                                       list_distinct(string_split(substr(text, half + 1), '')))) AS item FROM sacks)
SELECT d.doc_id, CAST(coalesce(sum(instr('{tx.PRIORITY_LETTERS}', item)) FILTER (WHERE item <> ''), 0) AS BIGINT) AS priority
FROM documents d LEFT JOIN items i ON i.doc_id = d.doc_id GROUP BY d.doc_id
""")
def rucksack_priority(spark, d):
    sacks = texts.shared_item_priority(table(spark, d, "documents", "doc_id", "text"), "text")
    return sacks.withColumn("priority", F.col("priority").cast("bigint"))


@query("move_parse", r"""
SELECT line_key, CAST(nullif(regexp_extract(line, '^move ([\d]+) from ([\d]+) to ([\d]+)', 1), '') AS INTEGER) AS boxes,
       CAST(nullif(regexp_extract(line, '^move ([\d]+) from ([\d]+) to ([\d]+)', 2), '') AS INTEGER) AS src,
       CAST(nullif(regexp_extract(line, '^move ([\d]+) from ([\d]+) to ([\d]+)', 3), '') AS INTEGER) AS dest
FROM (SELECT l_orderkey * 10 + l_linenumber AS line_key,
             CASE WHEN l_returnflag = 'N' THEN 'stay ' ELSE 'move ' END || CAST(l_quantity AS INTEGER) || ' from '
             || l_linenumber || ' to ' || l_suppkey AS line FROM lineitem)
""")
def move_parse(spark, d):
    verb = F.when(F.col("l_returnflag") == "N", "stay ").otherwise("move ")
    line = F.concat(verb, F.col("l_quantity").cast("int"), F.lit(" from "), "l_linenumber", F.lit(" to "), "l_suppkey")
    key = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_key")
    return texts.parse_moves(table(spark, d, "lineitem").select(key, line.alias("line")), "line").drop("line")


@query("conversation_ordinal", """
SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS ordinal FROM conversations
""")
def conversation_ordinal(spark, d):
    return global_ordinal(table(spark, d, "conversations").select("conv_id", "turn"), ["conv_id", "turn"])


@query("word_ordinals", r"""
SELECT n AS place, count(*) AS words, count(DISTINCT word) AS kinds
FROM (SELECT n, parts[n] AS word FROM (SELECT parts, unnest(generate_series(1, len(parts))) AS n
      FROM (SELECT string_split_regex(text, '\s+') AS parts FROM conversations)))
GROUP BY 1
""")
def word_ordinals(spark, d):
    from millrace.functions import arrays

    rows = table(spark, d, "conversations").select("text")
    words = arrays.unnest(rows, F.split("text", r"\s+"), "word", "place")
    return words.groupBy("place").agg(F.count("*").alias("words"), F.count_distinct("word").alias("kinds"))


@query("text_scalars", """
SELECT c_custkey, split_part(c_name, '#', 2) AS number, split_part(c_name, '#', 3) AS missing,
       rtrim(c_name, '0123456789') AS stem, left(c_mktsegment, 4) AS short_segment,
       replace(c_mktsegment, 'I', 'i') AS swapped, CAST(length(c_name) AS INTEGER) AS size,
       CASE WHEN c_name || '' LIKE '%#%' THEN '[' || c_nationkey || ']' END AS boxed,
       concat_ws('/', c_mktsegment, NULL, c_nationkey) AS joined,
       CASE WHEN contains(c_name, ':') THEN regexp_extract(c_name, '(.*):', 1) END AS before_colon
FROM customer
""")
def text_scalars(spark, d):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, d, "customer").select(
        "c_custkey", tx.part(name, "#", 2).alias("number"), tx.part(name, "#", 3).alias("missing"),
        tx.strip_right(name, "0123456789").alias("stem"), F.left(segment, F.lit(4)).alias("short_segment"),
        F.replace(segment, F.lit("I"), F.lit("i")).alias("swapped"), F.length(name).alias("size"),
        F.when(name.like("%#%"), F.format_string("[%s]", "c_nationkey")).alias("boxed"),
        F.concat_ws("/", segment, F.lit(None).cast("string"), F.col("c_nationkey").cast("string")).alias("joined"),
        F.get(tx.match_groups(name, "(.*):", 1), F.lit(0)).alias("before_colon"),
    )


@query("pretty_sizes", """
SELECT o_orderkey, CASE
    WHEN b < 10240 THEN b || ' bytes'
    WHEN b // 512 < 20479 THEN ((b // 512) + 1) // 2 || ' kB'
    WHEN b // 524288 < 20479 THEN ((b // 524288) + 1) // 2 || ' MB'
    WHEN b // 536870912 < 20479 THEN ((b // 536870912) + 1) // 2 || ' GB'
    ELSE ((b // 549755813888) + 1) // 2 || ' TB' END AS size
FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * power(10, o_orderkey % 9)::BIGINT // 100 AS b FROM orders)
""")
def pretty_sizes(spark, d):
    scaled = F.floor("o_totalprice").cast("bigint") * F.pow(F.lit(10), F.col("o_orderkey") % 9).cast("bigint")
    size = F.floor(scaled / 100).cast("bigint")
    rows = table(spark, d, "orders").select("o_orderkey", size.alias("b"))
    return rows.select("o_orderkey", tx.pretty_bytes(F.col("b")).alias("size"))


_TASKS_SQL = """
SELECT l_linenumber, count(*) AS pairs, CAST(sum(CASE WHEN (a <= c AND b >= d) OR (c <= a AND d >= b) THEN 1 ELSE 0 END) AS BIGINT) AS overlaps
FROM (SELECT l_linenumber, l_partkey % 50 AS a, l_partkey % 50 + l_linenumber AS b, l_suppkey % 50 AS c,
             l_suppkey % 50 + CAST(floor(l_quantity / 10) AS BIGINT) AS d FROM lineitem)
GROUP BY l_linenumber
"""


def _tasks(spark, d):
    a, c = F.col("l_partkey") % 50, F.col("l_suppkey") % 50
    b, e = a + F.col("l_linenumber"), c + F.floor(F.col("l_quantity") / 10)
    first = F.concat_ws("-", a.cast("string"), b.cast("string"))
    second = F.concat_ws("-", c.cast("string"), e.cast("string"))
    rows = table(spark, d, "lineitem", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return rows.select("l_linenumber", F.concat_ws(",", first, second).alias("tasks"))


def _overlap_counts(rows):
    return rows.groupBy("l_linenumber").agg(F.count("*").alias("pairs"), F.sum("overlap").alias("overlaps"))


@query("range_containment", _TASKS_SQL)
def range_containment(spark, d):
    return _overlap_counts(texts.nested_tasks(_tasks(spark, d), "tasks"))


@query("range_containment_arrays", _TASKS_SQL)
def range_containment_arrays(spark, d):
    return _overlap_counts(texts.nested_tasks_by_values(_tasks(spark, d), "tasks"))


@query("range_lower_filter", """
SELECT o_orderstatus, count(*) AS n, strftime(max(o_orderdate + INTERVAL 3 DAY), '%Y-%m-%d') AS last_end
FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01' GROUP BY 1
""")
def range_lower_filter(spark, d):
    period = ranges.make(F.col("o_orderdate"), F.timestamp_add("DAY", F.lit(3), F.col("o_orderdate")))
    rows = table(spark, d, "orders").select("o_orderstatus", period.alias("period"))
    late = rows.where(ranges.lower(F.col("period")) > dates.as_ntz("1999-01-01 00:00:00"))
    last = F.date_format(F.max(ranges.upper(F.col("period"))), "yyyy-MM-dd")
    return late.groupBy("o_orderstatus").agg(F.count("*").alias("n"), last.alias("last_end"))


@query("json_each_props", """
SELECT event_id, key, json_extract_string(props, '$.' || key) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
""")
def json_each_props(spark, d):
    return docs.json_entries(table(spark, d, "events").select("event_id", "props"), "props").drop("props")


@query("json_object_agg", """
SELECT l_orderkey, '{' || string_agg('"' || l_returnflag || '":' || coalesce(CAST(v AS VARCHAR), 'null'), ',' ORDER BY l_returnflag, v NULLS FIRST) || '}' AS flags
FROM (SELECT l_orderkey, l_returnflag, CASE WHEN l_linenumber % 3 > 0 THEN l_linenumber END AS v FROM lineitem) GROUP BY l_orderkey
""")
def json_object_agg(spark, d):
    """An object for each order, with a member for every line: flags repeat as keys."""
    rows = table(spark, d, "lineitem", "l_orderkey", "l_returnflag", "l_linenumber")
    rows = rows.withColumn("v", F.when(F.col("l_linenumber") % 3 > 0, F.col("l_linenumber")))
    return rows.groupBy("l_orderkey").agg(docs.json_object_agg("l_returnflag", "v").alias("flags"))


@query("json_build", """
SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS body FROM events
""")
def json_build(spark, d):
    return table(spark, d, "events").select("event_id", F.to_json(F.struct("user_id", "event_type")).alias("body"))


@query("xml_envelopes", """
SELECT '<data><row><OrderID>' || o_orderkey || '</OrderID></row><row><OrderID>' || (o_orderkey + 1)
       || '</OrderID></row></data>' AS body, o_orderkey AS first_id, o_orderkey + 1 AS last_id, 2 AS rows_in
FROM orders
""")
def xml_envelopes(spark, d):
    """Write two-row envelopes and read them back."""
    key = F.col("o_orderkey")
    rows = F.array(docs.xml_row("OrderID", key), docs.xml_row("OrderID", key + 1))
    bodies = table(spark, d, "orders", "o_orderkey").select(docs.xml_envelope(rows).alias("body"))
    parsed = bodies.withColumn("_p", docs.parse_envelope(F.col("body"), "OrderID", "bigint"))
    ids = F.col("_p.row.OrderID")
    valid = parsed.where(F.col(f"_p.{docs.CORRUPT}").isNull())
    return valid.select("body", F.get(ids, F.lit(0)).alias("first_id"), F.element_at(ids, -1).alias("last_id"),
                        F.size(ids).alias("rows_in"))


@query("sql_functions", f"""
SELECT p_partkey, w[1] AS first_word, array_to_string(w[2:3], ',') AS middle, list_has_all(w, ['red']) AS red,
       CAST(instr('{tx.PRIORITY_LETTERS}', left(p_name, 1)) AS INTEGER) AS priority, len(p_name) - 2 AS grams,
       (p_size <= 10 AND 20 >= p_size + 5) OR (10 <= p_size AND p_size + 5 >= 20) AS nested
FROM (SELECT p_partkey, p_name, p_size, string_split(p_name || ' ' || p_type, ' ') AS w FROM part)
""")
def sql_functions(spark, d):
    """The helpers called from SQL; the n-gram table function runs as a lateral join."""
    from millrace.functions import sql

    sql.register(spark)
    return spark.sql("""
        SELECT p_partkey, first_word, middle, red, priority, nested, count(*) + max(repeats) AS grams
        FROM (SELECT p_partkey, p_name, array_item(w, 1) AS first_word, array_join(array_between(w, 2, 3), ',') AS middle,
                     array_holds_all(w, array('red')) AS red, item_priority(left(p_name, 1)) AS priority,
                     ranges_nested(p_size, 20, 10, p_size + 5) AS nested,
                     length(p_name) - 2 - size(trigrams_of(p_name)) AS repeats
              FROM (SELECT p_partkey, p_name, p_size, split(concat_ws(' ', p_name, p_type), ' ') AS w FROM {part})),
             LATERAL generate_trigrams(p_name)
        GROUP BY ALL
    """, part=table(spark, d, "part")).select(
        "p_partkey", "first_word", "middle", "red", "priority", "grams", "nested")
