"""The column helpers as temporary SQL functions, for jobs written in SQL.

Each function is a SQL expression that Catalyst inlines; none runs Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.functions.rand import SYMBOLS
from millrace.functions.text import PRIORITY_LETTERS

_TWO_52 = 1 << 52


def _portable(key: str) -> str:
    """SQL for the portable uniform value of ``functions.rand`` for a seed and key text."""
    return f"(CAST(conv(substring(md5(concat_ws('|', CAST(seed AS STRING), {key})), 1, 13), 16, 10) AS BIGINT) / {_TWO_52}D)"


#: draw i (from 1) of a text: 16 bits of the hash of the key and (i - 1) div 8
_DRAW = "CAST(conv(substring(md5(concat_ws('|', CAST(seed AS STRING), row_key, CAST((i - 1) div 8 AS STRING))), 1 + 4 * ((i - 1) % 8), 4), 16, 10) AS INT)"
_SIZE = f"CAST(floor({_portable('row_key')} * (hi - lo) + lo) AS INT)"
_FIELD = "CAST(floor({u} * (lo - hi) + hi) AS BIGINT)"

FUNCTIONS = {
    # arrays, one-based with NULL (or nothing) outside
    "array_item": ("a ARRAY<STRING>, i INT", "STRING", "CASE WHEN i >= 1 THEN get(a, i - 1) END"),
    "array_between": ("a ARRAY<STRING>, lo INT, hi INT", "ARRAY<STRING>",
                      "slice(a, greatest(lo, 1), greatest(0, least(hi, size(a)) - greatest(lo, 1) + 1))"),
    "array_holds_all": ("a ARRAY<STRING>, b ARRAY<STRING>", "BOOLEAN", "size(array_except(b, a)) = 0"),
    # text
    "item_priority": ("letter STRING", "INT", f"position(letter, '{PRIORITY_LETTERS}')"),
    "first_match": ("s STRING, pattern STRING", "STRING",
                    "CASE WHEN s RLIKE pattern THEN regexp_extract(s, pattern, 1) END"),
    "trigrams_of": ("s STRING", "ARRAY<STRING>",
                    "CASE WHEN length(rtrim(s)) >= 3 THEN array_distinct(transform(sequence(1, length(rtrim(s)) - 2), "
                    "i -> substring(s, i, 3))) ELSE CAST(array() AS ARRAY<STRING>) END"),
    # ranges
    "ranges_nested": ("lo1 BIGINT, hi1 BIGINT, lo2 BIGINT, hi2 BIGINT", "BOOLEAN",
                      "(lo1 <= lo2 AND hi1 >= hi2) OR (lo2 <= lo1 AND hi2 >= hi1)"),
    # reproducible random values: u is uniform_of(seed, row key)
    "uniform_of": ("seed BIGINT, row_key STRING", "DOUBLE", f"(xxhash64(seed, row_key) & {_TWO_52 - 1}L) / {_TWO_52}D"),
    "random_between": ("u DOUBLE, lo DOUBLE, hi DOUBLE, round_to INT DEFAULT 0", "DOUBLE",
                       "CASE WHEN round_to = 0 THEN floor(u * (lo - hi) + hi) "
                       "ELSE floor((u * (lo - hi) + hi) * pow(10, round_to) + 0.5) / pow(10, round_to) END"),
    "random_text": ("seed BIGINT, row_key STRING, size INT", "STRING",
                    "CASE WHEN size < 1 THEN '' ELSE array_join(transform(sequence(1, size), i -> substring("
                    f"'{SYMBOLS}', CAST(floor((xxhash64(seed, row_key, i) & {_TWO_52 - 1}L) / {_TWO_52}D * {len(SYMBOLS)}) AS INT) + 1, 1)), '') END"),
    # the same values as in functions.rand with portable=True, for a key of one text
    "portable_uniform": ("seed BIGINT, row_key STRING", "DOUBLE", _portable("row_key")),
    "random_text_between": ("seed BIGINT, row_key STRING, lo INT, hi INT", "STRING",
                            f"CASE WHEN {_SIZE} >= 1 AND {_SIZE} % 5 > 1 THEN array_join(transform(sequence(1, {_SIZE}), i -> substring('{SYMBOLS}', "
                            + f"CAST(floor({_DRAW} * {len(SYMBOLS)} / 65536) AS INT) + 1, 1)), '') ELSE '' END"),
    "random_json": ("seed BIGINT, row_key STRING, lo INT, hi INT", "STRING",
                    f"CASE WHEN {_SIZE} % 5 > 1 THEN to_json(named_struct("
                    + ", ".join(f"'{k}', " + _FIELD.format(u=_portable(f"row_key, '{k}'")) for k in "abc") + ")) END"),
}

TABLE_FUNCTIONS = {
    "generate_trigrams": ("s STRING", "TABLE(trigram STRING)", f"SELECT explode({FUNCTIONS['trigrams_of'][2]})"),
    "split_rows": ("s STRING", "TABLE(ordinal INT, line STRING)", "SELECT pos + 1, col FROM posexplode(split(s, '\\\\r?\\\\n'))"),
}


def register(spark: SparkSession) -> list[str]:
    """Create (or replace) all functions in the session and return their names."""
    for group in (FUNCTIONS, TABLE_FUNCTIONS):
        for name, (arguments, result, body) in group.items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return [*FUNCTIONS, *TABLE_FUNCTIONS]
