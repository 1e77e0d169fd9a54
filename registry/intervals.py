"""Joins of ranges: order and shipping days, key ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import intervals
from registry import query, table


def _days(name):
    return F.unix_date(F.col(name).cast("date"))


@query("interval_overlap", """
SELECT a.o_orderkey AS order_key, b.l_orderkey AS shipped_key, CAST(a.o_orderdate AS DATE) - CAST(b.first AS DATE) AS days_in
FROM orders a JOIN (
  SELECT l_orderkey, any_value(o_custkey) AS custkey, min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) b
ON a.o_custkey = b.custkey AND CAST(a.o_orderdate AS DATE) <= CAST(b.last AS DATE) AND CAST(a.o_orderdate AS DATE) + INTERVAL 14 DAY >= CAST(b.first AS DATE)
WHERE a.o_orderkey <> b.l_orderkey
""")
def interval_overlap(spark, d):
    """Orders of a customer with the shipments under way within two weeks."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", _days("o_orderdate").alias("day"))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    shipped = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "l_orderkey", F.col("o_custkey").alias("custkey"), _days("first").alias("first"), _days("last").alias("last"))
    pairs = intervals.interval_join(orders, shipped, (F.col("day"), F.col("day") + 14), (F.col("first"), F.col("last")),
                                    on=[(F.col("o_custkey"), F.col("custkey"))])
    return pairs.where("left.o_orderkey <> right.l_orderkey").select(
        F.col("left.o_orderkey").alias("order_key"), F.col("right.l_orderkey").alias("shipped_key"),
        (F.col("left.day") - F.col("right.first")).cast("bigint").alias("days_in"))


@query("interval_nested", """
SELECT p_partkey, s_suppkey, p_partkey <= s_suppkey * 20 AND p_partkey + p_size >= s_suppkey * 20 + s_nationkey AS part_outside
FROM part JOIN supplier ON p_partkey <= s_suppkey * 20 AND p_partkey + p_size >= s_suppkey * 20 + s_nationkey
  OR p_partkey >= s_suppkey * 20 AND p_partkey + p_size <= s_suppkey * 20 + s_nationkey
""")
def interval_nested(spark, d):
    """Key ranges of parts and suppliers, where one lies within the other."""
    parts, suppliers = table(spark, d, "part").select("p_partkey", "p_size"), table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    lo, begin = F.col("p_partkey"), F.col("s_suppkey") * 20
    pairs = intervals.interval_join(parts, suppliers, (lo, lo + F.col("p_size")), (begin, begin + F.col("s_nationkey")), intervals.NESTED)
    start = F.col("right.s_suppkey") * 20
    outside = (F.col("left.p_partkey") <= start) & (F.col("left.p_partkey") + F.col("left.p_size") >= start + F.col("right.s_nationkey"))
    return pairs.select("left.p_partkey", "right.s_suppkey", outside.alias("part_outside"))


@query("interval_counts", """
SELECT user_id, count(*) AS met, CAST(sum(b.o_orderkey) AS BIGINT) AS keys FROM events a
JOIN orders b ON a.event_id <= b.o_orderkey + CAST(floor(b.o_totalprice) AS BIGINT) % 50 AND a.event_id + CASE WHEN a.event_id = 7 THEN 5000000 ELSE a.user_id % 5 END >= b.o_orderkey
GROUP BY user_id
""")
def interval_counts(spark, d):
    """Ranges of event numbers against ranges of order numbers; one of the ranges spans nearly all."""
    first = F.col("event_id")
    reach = F.when(first == 7, 5_000_000).otherwise(F.col("user_id") % 5)
    pairs = intervals.interval_join(
        table(spark, d, "events").select("event_id", "user_id"), table(spark, d, "orders").select("o_orderkey", "o_totalprice"),
        (first, first + reach), (F.col("o_orderkey"), F.col("o_orderkey") + F.col("o_totalprice").cast("bigint") % 50))
    return pairs.groupBy("left.user_id").agg(F.count("*").alias("met"), F.sum("right.o_orderkey").alias("keys"))
