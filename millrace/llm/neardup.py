"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

Documents with the same shingle set are one class from the start. A signature
hashes every shingle once; the hash picks a bin and its smallest value fills
it. Empty bins copy the bin that a fixed random order of their own visits
first (optimal densification), so that two sets agree in any bin with their
Jaccard similarity. Bands of bins make buckets.

A bucket links its members to one centre, not to each other: as many pairs as
members. Pairs are confirmed on the full shingle sets. Where the members of a
bucket then lie in several components, those outside the main component are
compared in blocks with all bucket mates by sketches that bound the similarity
from above, so no pair of a bucket goes unseen unless it is connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER_ASCII, Scratch

BANDS, ROWS = 40, 7
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WORDS_KEPT = 500_000
#: Bits of a sketch; documents in a block; parts over which the query blocks of a family are spread.
_SKETCH_BITS, _BLOCK, _SPREAD = 2048, 256, 8

SIGNATURE = "doc_id long, n_shingles long, set_key binary, buckets array<long>"


def words_of(text: str | None) -> list[bytes]:
    """Words between the characters x20 and x09 to x0D, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER_ASCII).split() if text else []


def shingles_of(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """Distinct word windows; a shorter text is one window; no words, no windows."""
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size))))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: list[bytes], size: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word windows."""
    hashed = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    h = hashed[: len(words) - width + 1].copy()
    for k in range(1, width):
        h = _mixed(h) * _M1 + hashed[k : len(words) - width + 1 + k]
    return np.unique(_mixed(h + np.uint64(width)))


def visiting_orders(bins: int) -> np.ndarray:
    """For each bin a random order of all bins, the same in every task."""
    rng = np.random.Generator(np.random.PCG64(20_240_101))
    return np.argsort(rng.random((bins, bins)), axis=1).astype(np.int16)


def signature(hashes: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Smallest hash of each bin; empty bins copy the first filled bin of their order."""
    bins = len(orders)
    at = ((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    values, filled = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    values[at[::-1]] = hashes[::-1]  # the smallest is written last
    filled[at] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = orders[empty]
        values[empty] = values[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return values


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.reshape(bands, -1)
    keys = np.arange(bands, dtype=np.uint64) * _M1
    for k in range(rows.shape[1]):
        keys = _mixed(keys ^ rows[:, k]) * _M1
    return keys.view(np.int64)


def signatures(docs: DataFrame, words: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``SIGNATURE`` of each row of ``docs`` (doc_id, text); no words: empty set, no key, no buckets."""
    kind = pa.list_(pa.int64())

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, orders = _WordHashes(), visiting_orders(bands * rows)
        for batch in stream:
            sizes, keys, found, ends = [], [], [], [0]
            for text in batch.column(1).to_pylist():
                tokens = words_of(text)
                if tokens:
                    hashes = shingle_hashes(tokens, words, cache)
                    sizes.append(len(hashes))
                    keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    found.append(band_keys(signature(hashes, orders), bands))
                else:
                    sizes.append(0)
                    keys.append(None)
                ends.append(len(found) * bands)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists.cast(kind)],
                names=["doc_id", "n_shingles", "set_key", "buckets"],
            )

    return docs.select("doc_id", "text").mapInArrow(batches, SIGNATURE)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets meet ``100 * common >= percent * union``."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, set()
        for batch in stream:
            kept = []
            for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns)):
                if text_a != last:  # rows come in the order of a
                    last, mine = text_a, shingles_of(text_a, words)
                other = shingles_of(text_b, words)
                common = len(mine & other)
                if 100 * common >= percent * (len(mine) + len(other) - common):
                    kept.append((a, b))
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in kept], schema=schema)

    return joined.mapInArrow(batches, "a long, b long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its smallest node.

    Alternating large-star and small-star steps: every step joins on a node,
    none gathers the neighbours of a node.
    """

    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.select("a", "b")
        if large:
            both = both.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        met = both.join(least, "a")
        if large:
            return met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return met.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()

    def mark(links: DataFrame):
        return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = scratch.pin(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = mark(now)
    while True:
        after = scratch.pin(star(star(now, large=True), large=False))
        is_at = mark(after)
        scratch.drop(now)
        now = after
        if is_at == seen:
            break
        seen = is_at
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def odd_sketches(texts: DataFrame, words: int) -> DataFrame:
    """(rep, n, sketch): a bit of the sketch says whether an odd number of shingles fell on it.

    Common shingles cancel out when two sketches are xor-ed, so the bits left
    are at most as many as the shingles that only one of the sets has.
    """
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHashes()
        for batch in stream:
            rows = []
            for node, text in zip(*(c.to_pylist() for c in batch.columns)):
                hashes = shingle_hashes(words_of(text), words, cache)
                odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) % _SKETCH_BITS, minlength=_SKETCH_BITS) & 1
                rows.append((node, len(hashes), np.packbits(odd.astype(np.uint8)).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 3, schema)], schema=schema)

    return texts.select("doc_id", "text").mapInArrow(batches, "rep long, n long, sketch binary")


def block_pairs(open_: DataFrame, texts: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of different components, in one family of open buckets, whose sketches allow the similarity.

    ``open_``: bucket, rep, centre, component. Families are the components of
    bucket mates. The members outside the main component of a family are the
    queries: blocks of them meet blocks of the family, and only pairs within
    the bound leave the task.
    """
    family = components(open_.where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")), scratch)
    nodes = open_.select("rep", "component").distinct().join(family.select(F.col("node").alias("rep"), F.col("component").alias("family")), "rep")
    wanted = texts.join(nodes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sketched = scratch.pin(nodes.join(odd_sketches(wanted, words), "rep"))
    counts = sketched.groupBy("family", "component").count().groupBy("family").agg(
        F.sum("count").alias("size"), F.max_by("component", F.struct("count", "component")).alias("main"))
    slotted = sketched.join(counts, "family").withColumn("slot", F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / _BLOCK)))
    entry = F.struct("rep", "n", "component", "sketch")
    mine = slotted.where("component <> main").groupBy("family", "slot").agg(F.collect_list(entry).alias("queries"))
    all_ = slotted.groupBy("family", "slot").agg(F.collect_list(entry).alias("others")).select(
        "family", F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1))).alias("salt"), "others")
    blocks = mine.select("family", (F.col("slot") % _SPREAD).cast("int").alias("salt"), "queries").join(all_, ["family", "salt"]).select("queries", "others")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def columns(block: pa.Array) -> tuple[np.ndarray, ...]:
        rep, n, component, sketch = (block.field(k) for k in ("rep", "n", "component", "sketch"))
        bits = np.frombuffer(b"".join(sketch.to_pylist()), np.uint64).reshape(len(rep), -1)
        return rep.to_numpy(), n.to_numpy(), component.to_numpy(), bits

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row in range(batch.num_rows):
                rep_q, n_q, component_q, bits_q = columns(batch.column(0)[row].values)
                rep_o, n_o, component_o, bits_o = columns(batch.column(1)[row].values)
                for k in range(len(rep_q)):
                    apart = np.bitwise_count(bits_o ^ bits_q[k]).sum(axis=1, dtype=np.int64)
                    near = (apart * (100 + percent) <= (100 - percent) * (n_o + n_q[k])) & (component_o != component_q[k])
                    if near.any():
                        other = rep_o[near]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(other, rep_q[k])), pa.array(np.maximum(other, rep_q[k]))], schema=schema)

    return blocks.mapInArrow(batches, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Links have ``100 * |A & B| >= percent * |A | B|`` for the sets of word
    windows. ``component_id`` is the smallest doc_id reachable over links,
    ``kept`` says whether the document is that one. Null or wordless texts have
    an empty set and link with nothing. Rows with the same doc_id are one node.
    Rows with a null doc_id are kept, without a component and without links.
    Other columns of ``docs`` are ignored.

    A pair at the threshold itself shares a bucket with probability
    1 - (1 - 0.8 ** rows) ** bands, 0.9999 with the defaults.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    signed = scratch.pin(signatures(docs, words, bands, rows))
    classes = signed.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.first("buckets").alias("buckets"), F.count("*").alias("copies"))
    reps = scratch.pin(classes)
    at = reps.select(F.explode("buckets").alias("bucket"), "rep", "n")
    first = at.groupBy("bucket").agg(F.min("rep").alias("centre"), F.count("*").alias("size")).where("size > 1").drop("size")
    members = scratch.pin(at.join(first, "bucket"))
    sizes = lambda a, b: F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")
    centres = members.where("rep = centre").select("bucket", F.col("rep").alias("a"), F.col("n").alias("n_a"))
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = scratch.pin(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"))
    pairs = members.where("rep <> centre").join(centres, "bucket").where(sizes("n", "n_a")).select("a", F.col("rep").alias("b")).distinct()
    links = scratch.pin(confirmed(pairs, texts, words, percent))
    labels = components(links, scratch)
    labelled = members.join(labels, members["rep"] == labels["node"], "left").select("bucket", "rep", "centre", F.coalesce("component", "rep").alias("component"))
    mixed = labelled.where("rep <> centre").groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    open_ = scratch.pin(labelled.join(mixed, "bucket", "left_semi"))
    if not open_.isEmpty():
        met = block_pairs(open_, texts, words, percent, scratch)
        labels = components(links.union(scratch.pin(confirmed(met, texts, words, percent))), scratch)
    copies = reps.where("copies > 1").select("set_key", "rep")
    own = signed.select("doc_id", "n_shingles", "set_key").join(copies, "set_key", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    grouped = own.join(labels, own["rep"] == labels["node"], "left").withColumn("component_id", F.coalesce("component", "rep"))
    return grouped.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
