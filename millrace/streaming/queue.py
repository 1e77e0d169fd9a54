"""Message queues: produce, receive, validate, fan out, dead letters.

A queue is a stream (or table) of messages ``conversation_handle,
message_type_name, message_body, service_contract_name, queuing_order,
attempts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import docs
from millrace.session import pin

# Names and codes that the messages and the error log use.
ORDER_MESSAGE = "OrderIDMsg"
ORDER_CONTRACT = "OrderRollupContract"
ID_FIELD = "OrderID"
CONVERSION_FAILED = 245
UNREADABLE = -999
MAX_ATTEMPTS = 5

MESSAGE_SCHEMA = (
    "conversation_handle string, message_type_name string, message_body string, "
    "service_contract_name string, queuing_order bigint, attempts int"
)
ERROR_SCHEMA = (
    "conversation_handle string, service_contract_name string, errorCode int, errorDescription string, "
    "message_type_name string, message_body string, queuing_order bigint, attempts int"
)


def order_messages(orders: DataFrame, order_id: str, handle: Column, sequence: Column,
                   body: Column | None = None) -> DataFrame:
    """One message per inserted order; no inserted rows give no messages."""
    single = docs.xml_envelope(F.array(docs.xml_row(ID_FIELD, F.col(order_id))))
    return orders.select(
        handle.cast("string").alias("conversation_handle"), F.lit(ORDER_MESSAGE).alias("message_type_name"),
        (single if body is None else body).alias("message_body"), F.lit(ORDER_CONTRACT).alias("service_contract_name"),
        sequence.cast("bigint").alias("queuing_order"), F.lit(0).alias("attempts"),
    )


def change_messages(changed: DataFrame, ids_per_message: int = 1000) -> DataFrame:
    """Envelopes of distinct order ids for a table of changed orders.

    Ids are spread over messages by hash, so no message holds an unbounded list.
    """
    ids = pin(changed.select(ID_FIELD).distinct(), "changed-ids")  # counted, then packed
    slots = F.greatest(F.lit(1).cast("bigint"), F.ceil(ids.agg(F.count("*")).scalar() / ids_per_message))
    grouped = ids.groupBy(F.pmod(F.xxhash64(ID_FIELD), slots).alias("_slot"))
    rows = grouped.agg(F.array_sort(F.collect_list(docs.xml_row(ID_FIELD, F.col(ID_FIELD)))).alias("_rows"))
    return order_messages(rows, "_slot", F.col("_slot"), F.col("_slot"), docs.xml_envelope(F.col("_rows")))


def unhandled(messages: DataFrame) -> DataFrame:
    """Messages of types that ``received`` does not read."""
    return messages.where(~F.col("message_type_name").eqNullSafe(F.lit(ORDER_MESSAGE)))


def received(messages: DataFrame) -> DataFrame:
    """Order messages with ``ids``, and ``error`` filled for the ones that cannot be read.

    Well-formed text with a value of the wrong type and broken text are told apart.
    """
    body = F.col("message_body")
    parsed = messages.where(F.col("message_type_name") == ORDER_MESSAGE)
    parsed = parsed.withColumn("_typed", docs.parse_envelope(body, ID_FIELD, "bigint"))
    readable = F.col(f"_typed.{docs.CORRUPT}").isNull()
    # only the messages that failed are parsed again, with the id as text
    parsed = parsed.withColumn("_loose", F.when(~readable, docs.parse_envelope(body, ID_FIELD, "string")))
    well_formed = F.col(f"_loose.{docs.CORRUPT}").isNull() & F.col(f"_loose.{docs.ENVELOPE_ROW}").isNotNull()
    code = F.when(~readable & well_formed, CONVERSION_FAILED).when(~readable, UNREADABLE)
    reason = F.when(well_formed, "conversion failed for the order id").otherwise("message is not well-formed")
    text = F.concat_ws(" | ", "message_type_name", "message_body", reason)
    ids = F.array_distinct(F.transform(F.col(f"_typed.{docs.ENVELOPE_ROW}"), lambda r: r[ID_FIELD]))
    return parsed.withColumns({
        "ids": F.when(code.isNull(), ids), "errorCode": code, "errorDescription": F.when(code.isNotNull(), text),
    }).drop("_typed", "_loose")


def fan_out(received_messages: DataFrame) -> DataFrame:
    """One row per order id of every good message (all rows, not only the first)."""
    good = received_messages.where("errorCode IS NULL")
    return good.select("conversation_handle", "queuing_order", F.explode("ids").alias(ID_FIELD))


def errors(received_messages: DataFrame) -> DataFrame:
    """Rows for the error log; the message leaves the queue."""
    bad = received_messages.where("errorCode IS NOT NULL").withColumn("attempts", F.col("attempts") + 1)
    return bad.select(*[part.split()[0] for part in ERROR_SCHEMA.split(", ")])


def inspect(dead: DataFrame) -> DataFrame:
    """Dead letters in queue order."""
    return dead.orderBy("queuing_order")


def discard(dead: DataFrame, handles: DataFrame) -> DataFrame:
    """Dead letters without the listed conversations."""
    return dead.join(handles.select("conversation_handle"), "conversation_handle", "left_anti")


def replay(dead: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Messages to send again, with their attempt count; poison messages stay behind."""
    return dead.where(F.col("attempts") < max_attempts).select(*[p.split()[0] for p in MESSAGE_SCHEMA.split(", ")])


def quarantined(dead: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    return dead.where(F.col("attempts") >= max_attempts)

