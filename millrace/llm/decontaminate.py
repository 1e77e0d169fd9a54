"""Benchmark passages in documents: q-gram lemma filter over diagonal bands, banded alignment.

Both sides are read as lower-case letters and digits with one blank between
words. A benchmark item is cut into patterns of at most 256 characters. A
pattern of m characters inside a document, with at most e edits, shares at
least m + 1 - q * (e + 1) q-grams with it, all on e + 1 neighbouring diagonals.
Bands of 2 * (e + 1) diagonals that overlap by half hold any such run, so a
band with fewer shared q-grams is dropped without loss. The others are aligned
on their diagonals and those that an alignment can reach below them.

The patterns travel to the tasks in blocks of bounded size, each with a pass
over the documents; a benchmark below the bound is one block.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of benchmark text in one block, of one pattern, of a read of documents, of a cut of an item.
BLOCK_CHARS, PATTERN_CHARS, READ_CHARS, PART_CHARS = 2_000_000, 256, 500_000, 65_536
Q, EDIT_RATE, MIN_CHARS = 8, 0.1, 24

_TABLED = 0x3000
_BLANK = 32
_GAP = 0xFFFFFFFF  # between documents read together; no character
_FILTER_BITS, _CASES, _TOGETHER = 22, 256, 200_000
SPANS = "doc_id long, item_id long, part int, pattern int, start long, end long, edits int"


def _letters() -> np.ndarray:
    """Code point to its lower-case form, 0 for separators."""
    out = np.zeros(_TABLED, np.uint32)
    for code in range(_TABLED):
        char = chr(code)
        if char.isalnum() or unicodedata.category(char)[0] == "M":
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def normalized(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the text with one blank for each run of separators, and where each stood."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = letters[np.minimum(points, _TABLED - 1)]
    if len(points) and points.max() >= _TABLED:
        codes = np.where(points >= _TABLED, points, codes)
    blank = codes == 0
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(keep)
    codes = codes[at]
    codes[codes == 0] = _BLANK
    if len(codes) and codes[-1] == _BLANK:
        codes, at = codes[:-1], at[:-1]
    return codes, at


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q characters from each place on; doubling, q a power of two."""
    h, width, factor = codes.astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while width < q:
        h = h[:-width] * np.uint64(factor) + (h[width:] ^ (h[width:] >> np.uint64(29)))
        factor = (factor * factor + 2) % (1 << 64)
        width *= 2
    return h ^ (h >> np.uint64(31))


class Patterns:
    """Patterns of a block of items with the index of their q-grams."""

    def __init__(self, items: list[tuple[int, int, str]], rate: float, min_chars: int):
        letters = _letters()
        self.codes, self.of = [], []
        for item_id, part, text in items:
            codes, _ = normalized(text, letters)
            if len(codes) >= min_chars:
                for k, piece in enumerate(np.array_split(codes, -(-len(codes) // PATTERN_CHARS))):
                    self.codes.append(piece)
                    self.of.append((item_id, part, k))
        size = np.array([len(c) for c in self.codes], np.int64)
        self.budget = np.minimum((size * rate).astype(np.int64), size // Q - 1)
        self.least = size + 1 - Q * (self.budget + 1)
        hashes = [gram_hashes(c) for c in self.codes]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])[order]
        self.place = np.concatenate([np.arange(len(h)) for h in hashes])[order] if hashes else flat.astype(np.int64)
        self.grams, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.longest = int(size.max()) if len(size) else 0


def band_costs(patterns: list[np.ndarray], texts: list[np.ndarray], lows: list[int], start: np.ndarray) -> np.ndarray:
    """Edits of each whole pattern against its text, per end diagonal ``low + t``.

    Row k of ``start`` has the costs to begin on the diagonals of case k; all
    cases advance one pattern character at a time.
    """
    cases, width = start.shape
    longest, far = max(map(len, patterns)), np.int32(1 << 20)
    chars = np.zeros((cases, longest), np.uint32)
    window = np.zeros((cases, longest + width), np.uint32)
    inside = np.zeros(window.shape, bool)
    for k, (pattern, text, low) in enumerate(zip(patterns, texts, lows)):
        chars[k, : len(pattern)] = pattern
        begin, end = max(0, low), min(len(text), low + longest + width)
        if end > begin:
            window[k, begin - low : end - low] = text[begin:end]
            inside[k, begin - low : end - low] = True
    size = np.array([len(p) for p in patterns])
    steps = np.arange(width, dtype=np.int32)
    cost, out = start.astype(np.int32), start.astype(np.int32)
    for j in range(longest):
        here = cost + (window[:, j : j + width] != chars[:, j : j + 1])
        here[~inside[:, j : j + width]] = far
        np.minimum(here[:, :-1], cost[:, 1:] + 1, out=here[:, :-1])
        cost = np.minimum.accumulate(here - steps, axis=1) + steps
        done = size == j + 1
        out[done] = cost[done]
    return out


def _begin_of(pattern: np.ndarray, text: np.ndarray, end: int, budget: int) -> int:
    """Where the best place of the pattern that ends before ``end`` begins."""
    window = text[max(0, end - len(pattern) - budget) : end][::-1]
    start = np.abs(np.arange(-budget, budget + 1))[None, :]
    back = band_costs([pattern[::-1]], [window], [-budget], start)[0]
    return max(0, end - len(pattern) - int(back.argmin()) + budget)


class Search:
    def __init__(self, patterns: Patterns):
        self.p, self.letters = patterns, _letters()
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._slot(patterns.grams)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def bands(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """(pattern, lowest diagonal that an alignment can use) of the bands of ``codes`` with enough q-grams."""
        p = self.p
        h = gram_hashes(codes)
        at = np.flatnonzero(self.filter[self._slot(h)])
        if not len(at):
            return []
        found = np.minimum(np.searchsorted(p.grams, h[at]), len(p.grams) - 1)
        same = p.grams[found] == h[at]
        at, found = at[same], found[same]
        times = p.count[found]
        total = int(times.sum())
        if not total:
            return []
        entry = np.repeat(p.first[found] - np.cumsum(times) + times, times) + np.arange(total)
        owner = p.owner[entry]
        width = p.budget[owner] + 1
        band = (np.repeat(at, times) - p.place[entry] + p.longest) // width
        keys, counts = np.unique((owner << 40) | band, return_counts=True)
        # the hits of a band: those of its own half and of the next
        after = np.searchsorted(keys, keys + 1)
        has = (after < len(keys)) & (keys[np.minimum(after, len(keys) - 1)] == keys + 1)
        sums = counts + np.where(has, counts[np.minimum(after, len(keys) - 1)], 0)
        # the path may leave its q-grams for lower diagonals, within the half below the lowest of them
        good = keys[sums >= p.least[keys >> 40]]
        return [(int(k >> 40), int(((k & ((1 << 40) - 1)) - 1) * (p.budget[k >> 40] + 1) - p.longest)) for k in good]

    def spans(self, units: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(unit, pattern, start, end, edits) of the places within the budget."""
        gap = np.full(Q, _GAP, np.uint32)
        starts = np.cumsum([0] + [len(u) + Q for u in units])
        found = self.bands(np.concatenate([x for u in units for x in (u, gap)]))
        for at in range(0, len(found), _CASES):
            cases = []
            for number, low in found[at : at + _CASES]:
                middle = low + (len(self.p.codes[number]) + 3 * int(self.p.budget[number]) >> 1)
                unit = min(max(int(np.searchsorted(starts, middle, "right")) - 1, 0), len(units) - 1)
                cases.append((number, unit, low - int(starts[unit])))
            width = 3 * max(int(self.p.budget[n]) + 1 for n, _, _ in cases)
            costs = band_costs([self.p.codes[n] for n, _, _ in cases], [units[u] for _, u, _ in cases],
                               [low for _, _, low in cases], np.zeros((len(cases), width), np.int32))
            for (number, unit, low), row in zip(cases, costs):
                t, budget = int(row.argmin()), int(self.p.budget[number])
                if row[t] <= budget:
                    pattern = self.p.codes[number]
                    end = low + t + len(pattern)
                    yield unit, number, _begin_of(pattern, units[unit], end, budget), end, int(row[t])


def _reads(text: str, letters: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The normalized text and its places, a long text in reads that overlap."""
    codes, at = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for begin in range(0, len(text), READ_CHARS):
        more, where = normalized(text[begin : begin + READ_CHARS], letters)
        if len(codes) and codes[-1] != _BLANK and normalized(text[begin - 1 : begin + 1], letters)[0].size < 2:  # separators at the cut
            codes, at = np.append(codes, np.uint32(_BLANK)), np.append(at, at[-1] + 1)
        codes, at = np.concatenate([codes[-overlap:], more]), np.concatenate([at[-overlap:], where + begin])
        yield codes, at


def blocks_of(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, int, str]]]:
    """Benchmark texts, long ones in parts, in lists of about ``block_chars`` characters."""
    cut = benchmark.where("text is not null and text <> ''").selectExpr(
        "cast(item_id as long) item_id", "text", f"cast(ceil(length(text) / {PART_CHARS}) as int) n").selectExpr(
        "item_id", "posexplode(transform(sequence(0, n - 1), k -> substring(text, cast(k * ceil(length(text) / n) as int) + 1, cast(ceil(length(text) / n) as int)))) as (part, text)")
    total = cut.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars)
    for k in range(blocks):
        rows = cut.where(F.pmod(F.xxhash64("item_id", "part", "text"), F.lit(blocks)) == k).collect()
        yield [tuple(r) for r in rows]


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, min_chars: int = MIN_CHARS,
                       block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Places of benchmark patterns in documents: ``SPANS``, offsets in code points of the text.

    ``docs`` (doc_id, text), ``benchmark`` (item_id, text); other columns are
    ignored. A place has at most ``rate`` edits per character of its pattern.
    Items of fewer than ``min_chars`` letters, digits and blanks are no
    evidence and match nothing. Null and empty texts have no places; null ids
    stay null; repeated rows give repeated places; an empty benchmark gives an
    empty result.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], SPANS)
    for items in blocks_of(benchmark, block_chars):
        shared = spark.sparkContext.broadcast((items, rate, min_chars))
        out = out.union(docs.select("doc_id", "text").mapInArrow(_scan(shared), SPANS))
    return out


def _scan(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("part", pa.int32()), ("pattern", pa.int32()),
                        ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])

    def places(search: Search, units: list) -> list[tuple]:
        best: dict[tuple, tuple] = {}
        for unit, number, begin, end, edits in search.spans([codes for _, _, codes, _ in units]) if units else ():
            row, doc_id, _, at = units[unit]
            first, last = int(at[begin]), int(at[end - 1]) + 1
            key = (row, number, last)
            if key not in best or edits < best[key][-1]:
                best[key] = (doc_id, *search.p.of[number], first, last, edits)
        return list(best.values())

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(Patterns(*shared.value))
        for batch in stream:
            rows, units, held = [], [], 0
            if search.p.codes:
                for row, (doc_id, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                    for codes, at in _reads(text, search.letters, 2 * search.p.longest) if text else ():
                        units.append((row, doc_id, codes, at))
                        held += len(codes)
                        if held >= _TOGETHER:
                            rows += places(search, units)
                            units, held = [], 0
                rows += places(search, units)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 7, schema)], schema=schema)

    return batches
