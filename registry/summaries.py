"""Group summaries, aggregates and formatted reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.arrays import ordered_array_agg, ordered_text_agg
from millrace.plans import measurements as ms
from millrace.sources import files, sinks
from millrace.session import fresh_path
from registry import query, table


def _readings(spark, d):
    return table(spark, d, "events").select(
        F.col("event_type").alias("station_name"), F.col("value").cast("decimal(10,2)").alias("measurement")
    )


_SUMMARY = """
SELECT event_type AS station_name,
       CAST(min(CAST(value AS DECIMAL(10,2))) AS DOUBLE) AS min_measurement,
       CAST(round(sum(CAST(value AS DECIMAL(10,2))) / count(*), 1) AS DOUBLE) AS mean_measurement,
       CAST(max(CAST(value AS DECIMAL(10,2))) AS DOUBLE) AS max_measurement
FROM events GROUP BY event_type ORDER BY event_type
"""


def _as_doubles(summary):
    figures = [F.col(c).cast("double").alias(c) for c in ("min_measurement", "mean_measurement", "max_measurement")]
    return summary.select("station_name", *figures)


@query("station_summary", _SUMMARY)
def station_summary(spark, d):
    return _as_doubles(ms.station_summary(_readings(spark, d)))


_LINE_SQL = """
SELECT '{' || string_agg(k || '=' || lo || '/' || mean || '/' || hi, ', ' ORDER BY k) || '}' AS result
FROM (SELECT event_type AS k, min(CAST(value AS DECIMAL(10,2))) AS lo,
             CAST(round(sum(CAST(value AS DECIMAL(10,2))) / count(*), 1) AS DECIMAL(10,1)) AS mean,
             max(CAST(value AS DECIMAL(10,2))) AS hi
      FROM events GROUP BY event_type)
"""


@query("station_summary_string", _LINE_SQL)
def station_summary_string(spark, d):
    return ms.summary_line(ms.station_summary(_readings(spark, d)))


@query("station_summary_castavg", """
SELECT event_type || '=' || concat_ws('/', min(CAST(value AS DECIMAL(10,2))),
       CAST(sum(CAST(value AS DECIMAL(10,2))) / count(*) AS DECIMAL(8,1)),
       max(CAST(value AS DECIMAL(10,2)))) AS entry
FROM events GROUP BY event_type
""")
def station_summary_castavg(spark, d):
    return ms.summary_entries(_readings(spark, d), "station_name", "measurement")


@query("csv_roundtrip_summary", _SUMMARY)
def csv_roundtrip_summary(spark, d):
    path = fresh_path(spark, "readings-csv")
    sinks.export_csv(_readings(spark, d), path, sep=";", header=False)
    back = files.read_delimited(spark, path, "station_name string, measurement decimal(10,2)", sep=";")
    return _as_doubles(ms.station_summary(back))


@query("csv_header_roundtrip", _SUMMARY)
def csv_header_roundtrip(spark, d):
    path = fresh_path(spark, "readings-csv")
    sinks.export_csv(_readings(spark, d), path)
    back = files.read_delimited(spark, path, "station_name string, measurement decimal(10,2)", header=True)
    return _as_doubles(ms.station_summary(back))


@query("csv_inferred_summary", _SUMMARY)
def csv_inferred_summary(spark, d):
    path = fresh_path(spark, "readings-csv")
    sinks.export_csv(_readings(spark, d), path, sep=";", header=False)
    back = files.read_inferred(spark, path, ["station_name", "measurement"], sep=";")
    exact = back.withColumn("measurement", F.col("measurement").cast("decimal(10,2)"))
    return _as_doubles(ms.station_summary(exact))


@query("hash_partition_summary", """
SELECT l_suppkey AS station_name, CAST(min(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS min_measurement,
       CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2))) / count(*), 1) AS DOUBLE) AS mean_measurement,
       CAST(max(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS max_measurement
FROM lineitem GROUP BY l_suppkey
""")
def hash_partition_summary(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("station_name"), F.col("l_extendedprice").cast("decimal(12,2)").alias("measurement")
    )
    path = fresh_path(spark, "hash-parts")
    sinks.write_hash_parts(rows, path, "station_name", 10)
    return _as_doubles(ms.station_summary(spark.read.parquet(path)))


@query("month_counts", """
SELECT strftime(o_orderdate, '%y-%m') AS order_month, count(*) AS orders
FROM orders GROUP BY 1 ORDER BY 1 DESC
""")
def month_counts(spark, d):
    from millrace.functions import dates

    months = table(spark, d, "orders").groupBy(dates.year_month(F.col("o_orderdate")).alias("order_month"))
    return months.agg(F.count("*").alias("orders")).orderBy(F.desc("order_month"))


@query("basic_aggregates", """
SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS total_quantity,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) / count(*), 4) AS mean_price,
       min(l_extendedprice) AS low_price, max(l_extendedprice) AS high_price
FROM lineitem GROUP BY l_returnflag
UNION ALL
SELECT 'all', count(*), CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE),
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) / count(*), 4),
       min(l_extendedprice), max(l_extendedprice)
FROM lineitem
""")
def basic_aggregates(spark, d):
    rows = table(spark, d, "lineitem")
    figures = [
        F.count("*").alias("n"),
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("total_quantity"),
        F.round(F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("double") / F.count("*"), 4).alias("mean_price"),
        F.min("l_extendedprice").alias("low_price"), F.max("l_extendedprice").alias("high_price"),
    ]
    whole = rows.groupingSets([[F.col("l_returnflag")], []], "l_returnflag").agg(F.grouping("l_returnflag").alias("_all"), *figures)
    return whole.withColumn("l_returnflag", F.when(F.col("_all") == 1, "all").otherwise(F.col("l_returnflag"))).drop("_all")


@query("pivot_counts", """
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS finished,
       count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
       max(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS top_first,
       max(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS top_second
FROM lineitem GROUP BY l_returnflag
""")
def pivot_counts(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count_if(F.col("l_linestatus") == "F").alias("finished"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.max(F.when(F.col("l_linenumber") == 1, F.col("l_quantity"))).alias("top_first"),
        F.max(F.when(F.col("l_linenumber") == 2, F.col("l_quantity"))).alias("top_second"),
    )


@query("joined_text", """
SELECT l_orderkey, string_agg(CASE WHEN l_linenumber % 3 > 0 THEN l_returnflag END, ', ' ORDER BY l_linenumber, l_returnflag) AS flags
FROM lineitem GROUP BY l_orderkey
""")
def joined_text(spark, d):
    """Flags of the lines of an order, repeated ones too; missing ones are left out."""
    flag = F.when(F.col("l_linenumber") % 3 > 0, F.col("l_returnflag"))
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag")
    return rows.groupBy("l_orderkey").agg(ordered_text_agg(flag, ", ", ["l_linenumber", "l_returnflag"]).alias("flags"))


@query("distinct_keys", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_keys(spark, d):
    return table(spark, d, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("breakdown_sets", """
SELECT lang, source, quality, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars
FROM (SELECT d.lang, d.source, l.quality, d.n_chars FROM documents d JOIN labels l USING (doc_id))
GROUP BY GROUPING SETS ((lang), (source), (quality))
""")
def breakdown_sets(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    rows = rows.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    sets = [[F.col("lang")], [F.col("source")], [F.col("quality")]]
    grouped = rows.groupingSets(sets, "lang", "source", "quality")
    return grouped.agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))


@query("ordered_array_agg", """
SELECT l_orderkey, array_to_string(list(coalesce(CAST(CASE WHEN l_linenumber % 3 > 0 THEN CAST(l_quantity AS INTEGER) END AS VARCHAR), 'NULL')
       ORDER BY l_linenumber, l_quantity), ',') AS quantities
FROM lineitem GROUP BY l_orderkey
""")
def ordered_array_agg_query(spark, d):
    """Quantities of the lines of an order in line order, with repeated and NULL ones."""
    quantity = F.when(F.col("l_linenumber") % 3 > 0, F.col("l_quantity").cast("int"))
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    listed = rows.groupBy("l_orderkey").agg(ordered_array_agg(quantity, ["l_linenumber", "l_quantity"]).alias("q"))
    return listed.select("l_orderkey", F.array_join("q", ",", "NULL").alias("quantities"))


@query("filtered_array_agg", """
SELECT l_orderkey, array_to_string(list(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) ORDER BY l_quantity DESC) FILTER (WHERE l_linestatus = 'F'), ',') AS finished
FROM lineitem GROUP BY l_orderkey
""")
def filtered_array_agg(spark, d):
    """Quantities of the finished lines of an order, largest first; NULL where no line is finished."""
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linestatus", "l_quantity").withColumn("down", -F.col("l_quantity"))
    listed = rows.groupBy("l_orderkey").agg(
        ordered_array_agg(F.col("l_quantity").cast("int"), ["down"], F.col("l_linestatus") == "F").alias("q"))
    return listed.select("l_orderkey", F.array_join("q", ",").alias("finished"))
