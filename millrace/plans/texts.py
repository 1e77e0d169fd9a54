"""Text formats turned into rows and columns, one input row at a time.

All of these are per-row expressions or generators: no shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import arrays, ranges
from millrace.functions import text as tx


def text_rows(df: DataFrame, text: str, line: str = "line", ordinal: str = "line_no") -> DataFrame:
    """One row per line of a text block, numbered from 1."""
    return arrays.unnest(df, tx.lines(F.col(text)), line, ordinal)


def hand_cards(hands: DataFrame, line: str = "lines") -> DataFrame:
    """``'32T3K 765'`` -> one row per card with its position, next to the bid."""
    cards, bid = tx.part(F.col(line), " ", 1), tx.part(F.col(line), " ", 2)
    split = hands.withColumn("bid", bid).withColumn("_cards", tx.chars(cards))
    return arrays.unnest(split, "_cards", "card", "position").drop("_cards", line)


def guess_scores(posts: DataFrame, text: str) -> DataFrame:
    """Letters per guess row of a word-game post: correct, partial, incorrect."""
    found = posts.withColumn("_guesses", tx.all_matches(F.col(text), tx.GUESS_PATTERN))
    guesses = arrays.unnest(found, "_guesses", "_guess", "guess_num")
    letters = tx.all_matches(F.col("_guess"), tx.LETTER_PATTERN)
    rows = guesses.withColumn("_letters", letters).where(F.size("_letters") > 0)

    def hits(*kinds: str):
        return F.size(F.filter("_letters", lambda letter: letter.isin(*kinds))).cast("bigint")

    return rows.select(
        *[c for c in posts.columns if c != text], "guess_num", hits("🟩").alias("c_correct"),
        hits("🟨").alias("c_partial"), hits("⬛", "⬜").alias("c_incorrect"),
    )


def shared_item_priority(sacks: DataFrame, contents: str, name: str = "priority") -> DataFrame:
    """Sum of the priorities of the letters found in both halves of each text.

    The distinct intersection is taken per row, so no rows are exploded.
    """
    first, second = tx.chars(tx.first_half(F.col(contents))), tx.chars(tx.second_half(F.col(contents)))
    shared = F.array_intersect(first, second)
    total = F.aggregate(shared, F.lit(0), lambda acc, item: acc + tx.priority(item))
    return sacks.withColumn(name, total).drop(contents)


def parse_moves(df: DataFrame, line: str) -> DataFrame:
    """``'move 3 from 1 to 2'`` -> boxes, src, dest; NULLs for any other line."""
    parsed = df.withColumn("_t", tx.match_groups(F.col(line), tx.MOVE_PATTERN, 3))
    names = ["boxes", "src", "dest"]
    values = [arrays.element(F.col("_t"), i).cast("int").alias(n) for i, n in enumerate(names, start=1)]
    return parsed.select(*df.columns, *values)


def nested_tasks(df: DataFrame, tasks: str) -> DataFrame:
    """``'2-8,3-7'`` -> 1 when one range holds the other, else 0."""
    first = ranges.parse(tx.part(F.col(tasks), ",", 1))
    second = ranges.parse(tx.part(F.col(tasks), ",", 2))
    return df.withColumn("overlap", ranges.nested(first, second).cast("int"))


def nested_tasks_by_values(df: DataFrame, tasks: str) -> DataFrame:
    """The same answer from the listed numbers of both ranges (a cross-check)."""
    first = ranges.values(ranges.parse(tx.part(F.col(tasks), ",", 1)))
    second = ranges.values(ranges.parse(tx.part(F.col(tasks), ",", 2)))
    inside = arrays.contains_all(first, second) | arrays.contained_by(first, second)
    return df.withColumn("overlap", inside.cast("int"))
