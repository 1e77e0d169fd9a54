"""Line-first quality rules: failing lines go, then documents that lost too much text go.

Every line is judged by itself: navigation (many separators, few words
between), symbols, shouting, boilerplate phrases, and missing sentence
punctuation. The text keeps its other lines. A document is rejected when less
than a given part of its characters is left, when the rest has too few words,
or when the base measures of the whole text say so.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

#: Words of a text: runs of anything but x20 and x09 to x0D.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
#: Phrases that mark a line as boilerplate. Fixed values.
BOILERPLATE = (
    "accept cookies", "all rights reserved", "back to top", "click here", "cookie policy", "cookies", "follow us",
    "forgot password", "lorem ipsum", "log in", "privacy policy", "read more", "share this", "sign in", "sign up",
    "skip to content", "subscribe", "terms of service", "terms of use",
)
_SEPARATORS = re.compile(r"[|•·›»>/]")
_ENDS = re.compile(r"""[.!?:;,。！？…]["'”’»)\]]*$""")
_PHRASES = re.compile("|".join(rf"\b{re.escape(p)}\b" for p in BOILERPLATE), re.IGNORECASE)


@dataclass(frozen=True)
class Rules:
    """Bounds of the line rules and of the verdict on the document."""

    separators: int = 3             # navigation: so many separators standing alone between words ...
    words_per_separator: float = 4  # ... with at most so many words to each
    symbols_per_word: float = 0.3   # more characters of SYMBOLS than this to a word
    shouted: float = 0.8            # part of the letters that are capitals, in lines of at least four words
    exclaimed: float = 0.5          # part of the words that end with an exclamation mark, likewise
    boilerplate_words: int = 12     # a boilerplate phrase counts in lines of at most so many words
    unpunctuated_words: int = 40    # lines of at least so many words need some sentence punctuation
    least_left: float = 0.5         # part of the characters of non-blank lines that must be left
    least_words: int = 50           # words that must be left
    repeated_percent: int = 50      # base: words in repeated windows


def line_fault(line: str, rules: Rules) -> str | None:
    """Name of the first rule that a line fails, or None."""
    words = line.split()
    n = len(words)
    if not n:
        return None
    symbols = sum(map(line.count, SYMBOLS))
    if symbols or "•" in line or "·" in line or "/" in line or "›" in line or "»" in line:
        alone = sum(1 for w in words if len(w) == 1 and _SEPARATORS.match(w))
        if alone >= rules.separators and n - alone <= rules.words_per_separator * alone:
            return "navigation"
        if symbols > rules.symbols_per_word * n:
            return "symbols"
    if n >= 4:
        if sum(w.endswith("!") for w in words) >= rules.exclaimed * n:
            return "shouting"
        letters = [c for c in line if c.isalpha()] if line.upper() == line or not line.islower() and sum(map(str.isupper, line)) * 2 > len(line) else []
        if letters and sum(map(str.isupper, letters)) >= rules.shouted * len(letters):
            return "shouting"
    if n <= rules.boilerplate_words and _PHRASES.search(line):
        return "boilerplate"
    if n >= rules.unpunctuated_words and not any(map(_ENDS.search, words)):
        return "punctuation"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    covered = until = 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + 3 - max(at, until)
            until = at + 3
    return covered


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_lines long, n_lines_removed long, chars_left long, reason string"
)

_KEPT = [f.split()[0] for f in MEASURES.split(", ")].index("kept")


def measured(text: str | None, rules: Rules) -> tuple:
    """``MEASURES`` of a text and the text of its good lines."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at just the six characters of WORD
    seen: set[str] = set()
    good, reasons, duplicate, removed, all_chars, left = [], Counter(), 0, 0, 0, 0
    faults: dict[str, str | None] = {}
    words_left = len(words)
    lines = text.split("\n")
    for line in lines:
        blank = not line or line.isspace() and not WORD.search(line)
        if blank:
            good.append(line)
            continue
        if line in seen:
            duplicate += 1
        else:
            seen.add(line)
            faults[line] = line_fault(line, rules)
        all_chars += len(line)
        if faults[line]:
            removed += 1
            reasons[faults[line]] += len(line)
            words_left -= len(WORD.findall(line))
        else:
            left += len(line)
            good.append(line)
    repeated = repeated_words(words)
    failed = len(words) < rules.least_words or 100 * repeated > rules.repeated_percent * len(words)
    reason = "base" if failed else None
    if not failed and (left < rules.least_left * all_chars or words_left < rules.least_words):
        reason = max(sorted(reasons), key=reasons.__getitem__)
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), duplicate, repeated, failed,
            reason is None, len(lines) if text else 0, removed, left, reason), "\n".join(good)


def judged(docs: DataFrame, rules: Rules = Rules(), with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``MEASURES``, and cleaned, the text without failing lines.

    ``kept`` is false if the base measures fail or too little is left;
    ``reason`` names the rule that took most. ``with_text=False`` leaves out cleaned. A null text counts as empty and
    is rejected for its zero words. Null ids and repeated rows are judged like
    any row; other columns are ignored.
    """
    ddl = f"doc_id long, {MEASURES}" + ", cleaned string" * with_text
    fields = [f.split() for f in ddl.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                values, cleaned = measured(text, rules)
                rows.append((doc_id, *values, cleaned) if with_text else (doc_id, *values))
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(batches, ddl)


def cleaned(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The kept rows of ``docs`` with failing lines taken out of text, and n_chars to match if there is such a column."""
    names = docs.columns

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            judgements = [measured(text, rules) for text in batch.column(names.index("text")).to_pylist()]
            texts = [text for _, text in judgements]
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}
            changed = pa.RecordBatch.from_arrays([new.get(n, batch.column(k)) for k, n in enumerate(names)], names=names)
            yield changed.filter(pa.array([values[_KEPT] for values, _ in judgements], pa.bool_()))

    ddl = ", ".join(f"`{name}` {'long' if name == 'n_chars' else kind}" for name, kind in docs.dtypes)
    return docs.mapInArrow(batches, ddl)
