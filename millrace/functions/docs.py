"""JSON objects and XML message envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names of the message envelope.
ENVELOPE_ROOT = "data"
ENVELOPE_ROW = "row"
CORRUPT = "_corrupt_record"


def json_entries(df: DataFrame, column: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per top-level key; a nested object stays JSON text."""
    parsed = F.from_json(F.col(column), "map<string,string>")
    return df.select("*", F.explode(parsed).alias(key, value))


def _json(value: Column) -> Column:
    """JSON text of one value."""
    text = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(2), F.length(text) - 2)


def json_object(pairs: Column) -> Column:
    """JSON object text from an array of ``struct<key, value>``; repeated keys stay, as do NULL values."""
    members = F.transform(pairs, lambda p: F.concat(_json(p["key"].cast("string")), F.lit(":"), _json(p["value"])))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def json_object_agg(key: str, value: str) -> Column:
    """Aggregate rows to one JSON object, keys in order; repeated keys stay. Group sizes must be bounded."""
    return json_object(F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("key"), F.col(value).alias("value")))))


def escape_xml(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def xml_row(field: str, value: Column) -> Column:
    body = escape_xml(value.cast("string"))
    return F.concat(F.lit(f"<{ENVELOPE_ROW}><{field}>"), body, F.lit(f"</{field}></{ENVELOPE_ROW}>"))


def xml_envelope(rows: Column) -> Column:
    """Envelope around an array of row elements."""
    return F.concat(F.lit(f"<{ENVELOPE_ROOT}>"), F.array_join(rows, ""), F.lit(f"</{ENVELOPE_ROOT}>"))


def parse_envelope(body: Column, field: str, field_type: str = "int") -> Column:
    """Envelope text -> ``struct<row: array<struct<field>>, _corrupt_record>``.

    A malformed text or a value of the wrong type fills ``_corrupt_record``.
    """
    schema = f"{ENVELOPE_ROW} array<struct<{field}:{field_type}>>, {CORRUPT} string"
    return F.from_xml(body, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
