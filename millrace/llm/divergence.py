"""Word use of sources against each other: Iceberg prefix refinement, then exact smoothed shares.

Only terms in enough documents of their language count, and most distinct terms
of a corpus are not. Tasks read the documents once and write, per batch of
text, in how many documents each term prefix of 2, 4, 8, ... bytes occurs.
Level by level these counts are added up; a longer prefix is only looked at
under a prefix that reached the threshold, and a term is settled on the level
that holds it whole. Rare terms leave with their prefix, before anything is
grouped by term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch
from millrace.session import fresh_path

AT_LEAST, ADDED, SCALE, RANKS = 30, 5, 1_000_000_000, 50
#: Bytes of text counted together; terms in a block and sources in a tile of the pair sums; rows of a table that may be broadcast.
_TOGETHER, _BLOCK_TERMS, _TILE_SOURCES, _SENT_ROWS = 6_000_000, 2_000, 256, 500_000

#: Letters and all beyond ASCII stay, capitals become small, the rest of ASCII separates.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))

_COUNTS = "lang string, source string, piece binary, whole boolean, docs long, n long, level int"
_COUNTS_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("piece", pa.binary()), ("whole", pa.bool_()),
                           ("docs", pa.int64()), ("n", pa.int64()), ("level", pa.int32())])


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(begin, number) of texts with together about ``_TOGETHER`` bytes."""
    begin = held = 0
    for at, size in enumerate(pc.binary_length(texts).to_pylist(), 1):
        held += size
        if held >= _TOGETHER or at == len(texts):
            yield begin, at - begin
            begin, held = at, 0


def _terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Document of each term, and the terms, of texts without nulls."""
    wide = pa.concat_arrays([texts.cast(pa.large_string())])
    ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    letters = (wide.buffers()[2] or b"") and wide.buffers()[2].to_pybytes()[ends[0] : ends[-1]].translate(_LETTERS)
    spaced = pa.Array.from_buffers(pa.large_string(), len(wide), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(letters)])
    split = pc.split_pattern(spaced, " ")
    words = split.flatten()
    owners = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    filled = pc.greater(pc.binary_length(words), 0)
    return owners[filled.to_numpy(zero_copy_only=False)], words.filter(filled)


def _counted(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> Iterator[pa.RecordBatch]:
    """On level k, documents of a language with a longer term under each prefix of 2**k bytes, and of a source with each whole term of up to so many bytes."""
    owners, words = _terms(texts)
    coded = pc.dictionary_encode(words)
    order = pc.array_sort_indices(coded.dictionary.cast(pa.large_binary()))
    terms = coded.dictionary.take(order).cast(pa.binary())
    n_terms = len(terms)
    if not n_terms:
        return
    rank = np.empty(n_terms, np.int64)
    rank[order.to_numpy()] = np.arange(n_terms)
    keys, times = np.unique(owners * n_terms + rank[coded.indices.to_numpy(zero_copy_only=False)], return_counts=True)
    owner, term = np.divmod(keys, n_terms)
    lang, source = pc.dictionary_encode(langs), pc.dictionary_encode(sources)
    of_lang, of_source = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner] for c in (lang, source))
    sizes = pc.binary_length(terms).to_numpy(zero_copy_only=False)

    def rows(groups, group_sources, pieces, whole, docs, n, level):
        return pa.RecordBatch.from_arrays([
            lang.dictionary.take(pa.array(groups)), group_sources, pieces, pa.array(np.full(len(docs), whole)), pa.array(docs), n,
            pa.array(np.full(len(docs), level, np.int32))], schema=_COUNTS_ARROW)

    keys = (of_lang * len(source.dictionary) + of_source) * n_terms + term
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    group, at = np.divmod(keys[first], n_terms)
    group_lang, group_source = np.divmod(group, len(source.dictionary))
    docs, n = np.diff(first, append=len(keys)), np.add.reduceat(times[order], first)
    level, width = 1, 2
    while True:
        here = (sizes[at] <= width) & ((sizes[at] > width // 2) | (level == 1))
        yield rows(group_lang[here], source.dictionary.take(pa.array(group_source[here])), terms.take(pa.array(at[here])), True, docs[here], pa.array(n[here]), level)
        longer = sizes > width
        if not longer.any():
            return
        pieces = pc.binary_slice(terms, 0, width)
        differs = np.ones(n_terms, bool)  # terms are in order, so those of a prefix follow each other
        differs[1:] = pc.not_equal(pieces[1:], pieces[:-1]).to_numpy(zero_copy_only=False)
        piece, firsts = np.cumsum(differs) - 1, np.flatnonzero(differs)
        kept = longer[term]
        own_doc, own_piece, own_lang = owner[kept], piece[term[kept]], of_lang[kept]
        fresh = np.ones(len(own_doc), bool)
        fresh[1:] = (own_doc[1:] != own_doc[:-1]) | (own_piece[1:] != own_piece[:-1])
        found, many = np.unique(own_lang[fresh] * len(firsts) + own_piece[fresh], return_counts=True)
        in_lang, under = np.divmod(found, len(firsts))
        yield rows(in_lang, pa.nulls(len(many), pa.string()), pieces.take(pa.array(firsts[under])), False, many, pa.nulls(len(many), pa.int64()), level)
        level, width = level + 1, width * 2


def prefix_counts(docs: DataFrame) -> DataFrame:
    """``_COUNTS`` of batches of ``docs`` (text, lang, source without nulls), stored in a folder per level."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts, langs, sources = (batch.column(c) for c in ("text", "lang", "source"))
            for begin, number in _runs(texts):
                yield from _counted(*(c.slice(begin, number) for c in (texts, langs, sources)))

    path = fresh_path(docs.sparkSession, "prefixes")
    docs.select("text", "lang", "source").mapInArrow(batches, _COUNTS).write.partitionBy("level").parquet(path)
    return docs.sparkSession.read.schema(_COUNTS).parquet(path)


def sent(df: DataFrame, rows: int) -> DataFrame:
    """A table as a side to broadcast if its rows are few; else Spark joins by shuffle."""
    return F.broadcast(df) if rows <= _SENT_ROWS else df


def kept_terms(counts: DataFrame, at_least: int = AT_LEAST) -> DataFrame:
    """(lang, piece) of the terms in ``at_least`` documents of their language, refined from ``prefix_counts``."""
    scratch = Scratch(counts.sparkSession, "iceberg")
    kept, parents, n_parents, level = None, None, 0, 1
    while True:
        rows = counts.where(F.col("level") == level)
        if parents is not None:
            stem = F.substring("piece", 1, 2 ** (level - 1))
            rows = rows.withColumn("stem", stem).join(sent(parents, n_parents), ["lang", "stem"], "left_semi")
        grown = scratch.pin(rows.groupBy("lang", "piece", "whole").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= at_least))
        settled = grown.where("whole").select("lang", "piece")
        kept = settled if kept is None else kept.unionByName(settled)
        parents = grown.where("not whole").select("lang", F.col("piece").alias("stem"))
        n_parents = parents.count()
        if not n_parents:
            return scratch.pin(kept)
        level += 1


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms)), exact; 0 without terms."""
    over = (F.lit(SCALE).cast("decimal(10,0)") * (count + ADDED).cast("decimal(20,0)")).alias("over")
    under = (total + terms * ADDED).cast("decimal(20,0)")
    return F.when(terms > 0, F.call_function("div", over, under) + 1).otherwise(F.lit(0).cast("long"))


def _tile(table: pa.Table) -> pa.Table:
    """Sums of differences between the sources of two tiles, over the terms of a block."""
    lang, low, high = (table.column(c)[0].as_py() for c in ("lang", "low", "high"))
    named, tile = table.column("source").combine_chunks().dictionary_encode(), table.column("tile").to_numpy()
    coded = table.column("piece").combine_chunks().dictionary_encode()
    code, row, p = coded.indices, named.indices.to_numpy(), table.column("p").to_numpy()
    is_base = pc.is_null(code).to_numpy(zero_copy_only=False)
    of = np.zeros(len(named.dictionary), np.int64)
    of[row] = tile
    shares = np.zeros((len(named.dictionary), len(coded.dictionary) + 1), np.int64)
    shares[row[is_base]] = p[is_base][:, None]
    shares[row[~is_base], code.drop_null().to_numpy()] = p[~is_base]
    shares = shares[:, : len(coded.dictionary)]
    lows, highs = np.flatnonzero(of == low), np.flatnonzero(of == high)
    out = {"lang": [], "one": [], "other": [], "value": []}
    for a in lows.tolist():
        others = highs[highs > a] if low == high else highs
        if len(others):
            sums = np.abs(shares[others] - shares[a]).sum(1)
            out["lang"].append(np.full(len(others), lang, object))
            out["one"].append(np.full(len(others), a))
            out["other"].append(others)
            out["value"].append(sums)
    flat = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}
    names = named.dictionary
    return pa.table({"lang": pa.array(flat["lang"].tolist(), pa.string()), "one": names.take(pa.array(flat["one"], pa.int64())),
                     "other": names.take(pa.array(flat["other"], pa.int64())), "value": pa.array(flat["value"], pa.int64())})


def pair_sums(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, one, other, value) of all pairs of sources of a language, each once.

    ``groups`` has lang, source, base (share of an absent term), terms (of the
    language) and sources (of the language); ``shares`` has lang, source, piece
    and p of the present terms. A task gets the terms of one block for the
    sources of two tiles.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / _BLOCK_TERMS))
    tiles = F.ceil(F.col("sources") / _TILE_SOURCES)
    placed = groups.withColumn("blocks", blocks).withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("source"), "tiles"))
    seeds = placed.select("lang", "source", "tile", "tiles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                          F.lit(None).cast("binary").alias("piece"), F.col("base").alias("p"))
    values = shares.join(placed.select("lang", "source", "tile", "tiles", "blocks"), ["lang", "source"]).select(
        "lang", "source", "tile", "tiles", F.pmod(F.xxhash64("piece"), "blocks").alias("block"), "piece", "p")
    offered = seeds.unionByName(values).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    paired = offered.withColumns({"low": F.least("tile", "with"), "high": F.greatest("tile", "with")})
    parts = paired.select("lang", "source", "tile", "block", "low", "high", "piece", "p").groupBy("lang", "block", "low", "high").applyInArrow(
        _tile, "lang string, one string, other string, value long")
    named = parts.select("lang", F.least("one", "other").alias("one"), F.greatest("one", "other").alias("other"), "value")  # a block may meet them either way round
    return named.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def audited(docs: DataFrame, at_least: int = AT_LEAST, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of each source to the others, and the terms it uses more than its language.

    Null text, lang and source are ''. Each row is a document: repeated rows
    count again, and ids are not used. Other columns are ignored. Parts
    ``pair`` and ``term`` are ranked by value, ties by item in UTF-8 order; a
    source alone in its language has no pair, and one without kept terms no
    term. No documents, no rows. A document must fit a task.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    read = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = prefix_counts(read)
    kept = kept_terms(counts, at_least)
    used = counts.where("whole").join(sent(kept, kept.count()), ["lang", "piece"], "left_semi")
    used = scratch.pin(used.groupBy("lang", "source", "piece").agg(F.sum("n").alias("n")))
    sizes = read.select("lang", "source").distinct().join(used.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    of_lang = sizes.groupBy("lang").agg(F.count("*").alias("sources"), F.coalesce(F.sum("total"), F.lit(0)).alias("lang_total")).join(
        kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left").fillna(0, ["terms"])
    groups = sizes.fillna(0, ["total"]).join(of_lang, "lang")
    groups = scratch.pin(groups.withColumn("base", _share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))))
    shares = used.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("total"), F.col("terms")))
    sums = pair_sums(groups, shares.select("lang", "source", "piece", "p"))
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("one").alias("item"))))
    pairs = sums.select("lang", "value", both.alias("b")).select("lang", "b.source", F.lit("pair").alias("part"), "b.item", "value")
    whole = used.groupBy("lang", "piece").agg(F.sum("n").alias("lang_n"))
    more = shares.join(whole, ["lang", "piece"]).withColumn("value", F.col("p") - _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")))
    terms = more.where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("piece").cast("string").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [rows.withColumn("rank", F.row_number().over(order)) for rows in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= ranks))
