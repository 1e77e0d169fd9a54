"""Join reports over rentals, payments and customers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import pin


def sorted_report(df: DataFrame, order: list[Column]) -> DataFrame:
    """Large sorted result: one range shuffle, sort with spill on the executors."""
    return df.orderBy(*order)


def above_group_average(facts: DataFrame, members: DataFrame, member: str, group: str, columns: list[str],
                        count: str = "cnt") -> DataFrame:
    """Members with more facts than the mean of their group.

    Two aggregates: facts per member, pinned, then the mean per group over the
    members that have facts. ``sum / count`` is compared by multiplication, so no
    rounding is involved.
    """
    counts = facts.groupBy(member).agg(F.count("*").alias(count))
    per_member = pin(members.select(member, group, *columns).join(counts, member), "per-member")
    means = per_member.groupBy(group).agg(F.sum(count).alias("_sum"), F.count("*").alias("_members"))
    joined = per_member.join(means, group)
    exact = "decimal(18,0)"
    scaled = F.col(count).cast(exact) * F.col("_members").cast(exact)
    return joined.where(scaled > F.col("_sum")).select(member, group, *columns, count)


def above_group_average_correlated(facts: DataFrame, members: DataFrame) -> DataFrame:
    """The same report as a nested correlated subquery; Catalyst turns it into joins.

    Expects ``facts(member)`` and ``members(member, grp)``.
    """
    spark = facts.sparkSession
    return spark.sql(
        """
        SELECT c.member, c.grp, f.cnt
        FROM {members} c JOIN (SELECT member, count(*) AS cnt FROM {facts} GROUP BY member) f ON c.member = f.member
        WHERE f.cnt > (SELECT avg(cnt) FROM (SELECT c2.grp, f2.member, count(*) AS cnt
                                             FROM {facts} f2 JOIN {members} c2 ON f2.member = c2.member
                                             GROUP BY c2.grp, f2.member) g WHERE g.grp = c.grp)
        """,
        facts=facts, members=members,
    )


def mean_after(df: DataFrame, ts: str, amount: str, after: dt.datetime) -> DataFrame:
    """Mean amount of the rows later than a moment."""
    late = df.where(F.col(ts) > F.lit(after.isoformat(sep=" ")).cast("timestamp_ntz"))
    return late.agg(F.avg(amount).alias("mean_amount"))
