"""Text helpers: splitting, pattern groups, character n-grams, sizes."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Item priorities run over the lower-case, then the upper-case letters.
PRIORITY_LETTERS = string.ascii_lowercase + string.ascii_uppercase

# Patterns of the text formats that the jobs read.
LINE_BREAK = r"\r?\n"
MOVE_PATTERN = r"^move ([\d]+) from ([\d]+) to ([\d]+)"
GUESS_PATTERN = "([🟩|🟧|🟨|🟦|⬛|⬜|]{5})"
LETTER_PATTERN = "([⬛|🟩|🟨|⬜]{1})"
CHANGE_DIR_PATTERN = r"\$ cd (.*)"
FILE_PATTERN = r"([\d]+) (.*)"


def lines(text: Column) -> Column:
    """Array of the lines of a text block, for either line ending."""
    return F.split(text, LINE_BREAK)


def chars(text: Column) -> Column:
    """Array of single characters; empty array for an empty text."""
    return F.when(F.length(text) > 0, F.split(text, "")).otherwise(F.array().cast("array<string>"))


def split_literal(text: Column, delimiter: str) -> Column:
    """Array of parts around a literal delimiter; no match keeps the whole text."""
    return F.split(text, re.escape(delimiter))


def part(text: Column, delimiter: str, n: int) -> Column:
    return F.split_part(text, F.lit(delimiter), F.lit(n))


def first_half(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))


def second_half(text: Column) -> Column:
    return F.substring(text, F.floor(F.length(text) / 2).cast("int") + 1, F.length(text))


def priority(letter: Column) -> Column:
    """1..52 for a..z, A..Z; 0 for any other character."""
    return F.position(letter, F.lit(PRIORITY_LETTERS))


def match_groups(text: Column, pattern: str, groups: int) -> Column:
    """Array of the groups of the first match; NULL when nothing matches."""
    found = [F.regexp_extract(text, pattern, g) for g in range(1, groups + 1)]
    return F.when(text.rlike(pattern), F.array(*found))


def all_matches(text: Column, pattern: str, group: int = 1) -> Column:
    """Array with one entry per match, in text order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def ngrams(text: Column, n: int = 3) -> Column:
    """Distinct n-character substrings; none when the text is shorter than n."""
    trimmed_length = F.length(F.rtrim(text))
    starts = F.sequence(F.lit(1), trimmed_length - (n - 1))
    grams = F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))
    none = F.array().cast("array<string>")
    return F.when(trimmed_length >= n, F.array_distinct(grams)).otherwise(none)


def strip_right(text: Column, characters: str) -> Column:
    """Remove any of ``characters`` from the end."""
    return F.rtrim(text, F.lit(characters))


def pretty_bytes(size: Column) -> Column:
    """Byte count with a unit: bytes below 10 kB, else the rounded larger unit."""
    units = ["kB", "MB", "GB", "TB", "PB"]
    out = None
    for step in reversed(range(len(units))):
        halves = F.floor(size / F.lit(float(2 ** (10 * (step + 1) - 1)))).cast("bigint")
        shown = F.concat(F.floor((halves + 1) / 2).cast("string"), F.lit(" " + units[step]))
        out = shown if out is None else F.when(halves < 20 * 1024 - 1, shown).otherwise(out)
    plain_text = F.concat(size.cast("bigint").cast("string"), F.lit(" bytes"))
    return F.when(size < 10 * 1024, plain_text).otherwise(out)
