"""Packing of documents into fixed windows: minimum bin slack over counts of lengths.

A document is cut into whole windows and a rest. Whole windows stand alone. Of
the rests only the count of each length matters, at most ``window - 1`` numbers
however large the corpus is. A window takes the longest rest left and the
multiset of other lengths whose sum comes closest to what is free: subset sums
over the counts are bits of one integer, and the sets seen after each length
lead back to the counts chosen. The same choice is repeated while its lengths
last, so there are at most as many different choices as lengths.

Pieces then take the places of their length in the order of their rank. Ranks
come from counts per (length, slice of the corpus), so that copies of one
length are spread over many tasks.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

WINDOW, END_ID = 4096, 2
#: Pieces that one task ranks.
SLICE_ROWS = 100_000
#: Words that a Python worker remembers, bytes of text that it works on together, and words given to the tokenizer at once.
_WORDS_KEPT, _TOGETHER, _ENCODED = 500_000, 6_000_000, 20_000
#: Words whose lower-casing goes letter by letter, with at most one mark behind them.
_SIMPLE = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+[.,]?$"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Runs:
    """Ids of words, one run for each: all ids in one array, and the sizes of the runs."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes = ids, sizes

    @staticmethod
    def one_after_another(many: list[Runs]) -> Runs:
        return Runs(np.concatenate([r.ids for r in many]), np.concatenate([r.sizes for r in many]))

    def take(self, which: np.ndarray) -> Runs:
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        shift = (np.cumsum(self.sizes) - self.sizes)[which] - (ends - sizes)
        return Runs(self.ids[np.repeat(shift, sizes) + np.arange(len(ends) and ends[-1])], sizes)


class WordIds:
    """Ids of the parts of texts between blanks.

    Only for tokenizers that lower-case, drop white space, never join over it
    nor letters with marks, and end each pre-token with ``</w>``. Only distinct
    words that were not met lately become Python objects.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known, self.runs = pa.array([], pa.string()), Runs(np.zeros(0, np.uint32), np.zeros(0, np.int64))
        self.marks = self._other([".", ",", ""])

    def _simple(self, words: list[str]) -> Runs:
        """Words of letters alone, encoded as one text."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, np.uint32)
        return Runs(ids, np.diff(np.flatnonzero(self.is_end[ids]) + 1, prepend=0))

    def _other(self, words: list[str]) -> Runs:
        coded = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return Runs(np.array([i for c in coded for i in c.ids], np.uint32), np.array([len(c.ids) for c in coded], np.int64))

    def _encoded(self, words: pa.Array, simple: np.ndarray) -> Runs:
        plain, rest = words.filter(pa.array(simple)), words.filter(pa.array(~simple))
        many = [Runs(np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for at in range(0, len(plain), _ENCODED):
            many.append(self._simple(plain[at : at + _ENCODED].to_pylist()))
        for at in range(0, len(rest), _ENCODED):
            many.append(self._other(rest[at : at + _ENCODED].to_pylist()))
        return Runs.one_after_another(many).take(np.where(simple, np.cumsum(simple) - 1, len(plain) + np.cumsum(~simple) - 1))

    def _distinct(self, words: pa.Array, simple: np.ndarray, times: np.ndarray) -> Runs:
        """Runs of distinct words that occur so many times, from memory or encoded now."""
        found = pc.index_in(words, value_set=self.known)
        missing = pc.is_null(found).to_numpy(zero_copy_only=False)
        new, held = words.filter(pa.array(missing)), len(self.known)
        coded = self._encoded(new, simple[missing])
        everything = Runs.one_after_another([self.runs, coded])
        out = everything.take(np.where(missing, held + np.cumsum(missing) - 1, pc.fill_null(found, 0).to_numpy(zero_copy_only=False)))
        if held + len(new) <= _WORDS_KEPT:
            self.known, self.runs = pa.concat_arrays([self.known, new]), everything
        else:  # go on with the words of this text that were known before or repeat
            keep = np.flatnonzero(~missing | (times > 1))[:_WORDS_KEPT]
            self.known, self.runs = words.take(pa.array(keep)), out.take(keep)
        return out

    def _runs(self, words: pa.Array, times: np.ndarray) -> Runs:
        """Runs of distinct words; simple words are looked up in small letters and without the mark behind them."""
        matched = pc.match_substring_regex(words, _SIMPLE)
        simple = matched.to_numpy(zero_copy_only=False)
        cores = pc.dictionary_encode(pc.if_else(matched, pc.utf8_lower(pc.utf8_rtrim(words, ".,")), words))
        core = cores.indices.to_numpy(zero_copy_only=False)
        is_simple = np.zeros(len(cores.dictionary), bool)
        is_simple[core] = simple
        runs = self._distinct(cores.dictionary, is_simple, np.bincount(core, times, len(cores.dictionary)))
        last = pc.utf8_slice_codeunits(words, -1)
        mark = np.where(simple, pc.fill_null(pc.index_in(last, value_set=pa.array([".", ","])), 2).to_numpy(zero_copy_only=False), 2)
        pairs = np.column_stack([core, len(runs.sizes) + mark]).ravel()
        both = Runs.one_after_another([runs, self.marks]).take(pairs)
        return Runs(both.ids, both.sizes.reshape(-1, 2).sum(1))

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text begins in it (with the end of the last)."""
        blank = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        parts = pc.split_pattern(blank, " ")
        coded = pc.dictionary_encode(parts.flatten())
        code = coded.indices.to_numpy(zero_copy_only=False)
        placed = self._runs(coded.dictionary, np.bincount(code, minlength=len(coded.dictionary))).take(code)
        first = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])
        return placed.ids, np.concatenate([[0], np.cumsum(placed.sizes)])[first]


#: Word ids of this Python worker, for all of its tasks.
_KNOWN: dict[str, WordIds] = {}


def by_size(lengths: list[int], most: int = _TOGETHER) -> Iterator[tuple[int, int]]:
    """(begin, end) of runs of texts with about so many bytes."""
    begin = held = 0
    for end, length in enumerate(lengths, 1):
        held += length
        if held >= most or end == len(lengths):
            yield begin, end
            begin, held = end, 0


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """``PIECES`` of each row of ``docs`` (doc_id, text): its ids and ``end_id``, cut every ``window`` ids."""
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens"))])
    last_id = np.array([end_id], "<u4").tobytes()

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _KNOWN.get(tokenizer) or _KNOWN.setdefault(tokenizer, WordIds(tokenizer))
        for batch in stream:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            rows = []
            for first, last in by_size(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                ids, at = words.documents(texts.slice(first, last - first))
                held, at = memoryview(ids).cast("B"), at.tolist()
                for doc_id, begin, end in zip(doc_ids[first:last], at, at[1:]):
                    total = end - begin + 1
                    for start in range(0, total, window):
                        upto = begin + start + window
                        crc = zlib.crc32(held[4 * (begin + start) : 4 * min(upto, end)])
                        rows.append((doc_id, start, min(window, total - start), zlib.crc32(last_id, crc) if upto > end else crc, total))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 5, schema)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(batches, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Multiset of lengths, within their counts, with the largest sum up to ``room``.

    Bit s of a set says that the sum s can be reached.
    """
    mask = (1 << (room + 1)) - 1
    lengths = [n for n in sorted(counts, reverse=True) if n <= room]
    sets = [1]
    for n in lengths:
        reach, left, step = sets[-1], min(counts[n], room // n), 1
        while left:  # 1, 2, 4, ... copies make every count up to ``left``
            take = min(step, left)
            reach |= (reach << (n * take)) & mask
            left -= take
            step *= 2
        sets.append(reach)
        if reach >> room:
            break
    total, chosen = sets[-1].bit_length() - 1, {}
    for n, before in zip(reversed(lengths[: len(sets) - 1]), reversed(sets[:-1])):
        used = 0
        while not before >> total & 1:
            total -= n
            used += 1
        if used:
            chosen[n] = used
    return chosen


def bin_choices(counts: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """(lengths of a sequence, number of such sequences) that use up all ``counts``."""
    left, out = {n: c for n, c in counts.items() if c}, []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        chosen = Counter(fullest({n: c for n, c in rest.items() if c}, window - longest))
        chosen[longest] += 1
        times = min(left[n] // k for n, k in chosen.items())
        out.append((dict(chosen), times))
        for n, k in chosen.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def places(choices: list[tuple[dict[int, int], int]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per length: (first rank, copies in a sequence, first sequence, offset) of each choice that has it."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for chosen, times in choices:
        offset = 0
        for n in sorted(chosen, reverse=True):
            out.setdefault(n, []).append((ranks[n], chosen[n], sequence, offset))
            ranks[n] += chosen[n] * times
            offset += n * chosen[n]
        sequence += times
    return out


def ranked(cut: DataFrame, rows: int) -> DataFrame:
    """``rank`` of each piece among those of its length, from counts of slices by hash of doc_id."""
    slices = max(1, -(-rows // SLICE_ROWS))
    sliced = cut.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)))
    counts = sliced.groupBy("length", "slice").count()
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "start", "ids_crc32")
    own = sliced.withColumn("own", F.row_number().over(within) - 1)
    return own.join(base, ["length", "slice"]).withColumn("rank", F.col("own") + F.col("base")).drop("slice", "own", "base")


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """``PIECES`` with sequence_id and offset: every id of every document in one place.

    A null or empty text is its ``end_id`` alone. Rows are packed one by one:
    repeated rows and null ids have pieces of their own. Sequences are filled
    without gaps from offset 0 and padded behind their last piece by the
    reader. Other columns are ignored. No documents, no pieces.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.pin(pieces(docs, tokenizer, window, end_id))
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``window`` rows
    table = places(bin_choices(counts, window))
    shared = spark.sparkContext.broadcast(table)
    kind = pa.int64()

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = {n: [p[0] for p in found] for n, found in shared.value.items()}
        for batch in stream:
            sequences, offsets = [], []
            for n, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                first, copies, sequence, offset = shared.value[n][bisect.bisect_right(firsts[n], rank) - 1]
                sequences.append(sequence + (rank - first) // copies)
                offsets.append(offset + (rank - first) % copies * n)
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequences, kind), pa.array(offsets, kind)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked(cut, sum(counts.values())).mapInArrow(batches, f"{PIECES}, sequence_id long, offset long")
