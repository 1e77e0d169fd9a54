"""Long-running sessions: first alert, then escalation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import dates

KEY = ["session_id", "login_name", "database_name", "start_time"]

# Thresholds in minutes, and the sessions that are never reported.
LOW_MINUTES, HIGH_MINUTES = 5, 30
SYSTEM_DATABASES = ["master", "msdb", "tempdb", "DBA_Stats"]
SYSTEM_PROGRAM_PATTERN = "%Service Broker%"
SYSTEM_PROGRAM = "SQBCoreService.exe"


def new_long_running(active: DataFrame, known: DataFrame, as_of: Column, low_minutes: int = LOW_MINUTES,
                     databases: list[str] = SYSTEM_DATABASES, program_like: str = SYSTEM_PROGRAM_PATTERN,
                     program: str = SYSTEM_PROGRAM) -> DataFrame:
    """Active sessions older than the low threshold that are not known yet."""
    old = F.col("start_time") < dates.before(as_of, low_minutes * 60)
    ours = ~F.col("database_name").isin(databases)
    wanted = old & ours & ~F.col("program_name").like(program_like) & (F.col("program_name") != program)
    fresh = active.where(wanted).join(known.select(*KEY), KEY, "left_anti")
    never = F.lit(None).cast("timestamp_ntz")
    return fresh.withColumns({
        "email_sent": F.lit(False), "email_time": never, "email2_sent": F.lit(False), "email2_time": never,
    })


def mark_low(known: DataFrame, as_of: Column) -> DataFrame:
    """After the first notice: all rows without one are marked as sent."""
    pending = ~F.col("email_sent")
    return known.withColumns({
        "email_time": F.when(pending, as_of).otherwise(F.col("email_time")), "email_sent": F.lit(True),
    })


def escalations(known: DataFrame, active: DataFrame, as_of: Column, high_minutes: int = HIGH_MINUTES) -> DataFrame:
    """Known sessions that still run past the high threshold and were not escalated."""
    running = active.where(F.col("start_time") < dates.before(as_of, high_minutes * 60)).select(*KEY)
    return known.where(~F.col("email2_sent")).join(running, KEY, "left_semi")


def mark_high(known: DataFrame, escalated: DataFrame, as_of: Column) -> DataFrame:
    """After the second notice: escalated rows that had the first notice are marked."""
    keys = escalated.select(*KEY).distinct().withColumn("_hit", F.lit(True))
    joined = known.join(keys, KEY, "left")
    due = F.coalesce(F.col("_hit"), F.lit(False)) & F.col("email_sent") & ~F.col("email2_sent")
    marked = joined.withColumns({
        "email2_time": F.when(due, as_of).otherwise(F.col("email2_time")),
        "email2_sent": due | F.col("email2_sent"),
    })
    return marked.select(*known.columns)
