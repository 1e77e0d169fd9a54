"""Source divergence audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, at_least, ranks):
    docs = [((t or "").translate(SMALL), l or "", s or "") for t, l, s in rows]
    seen, used, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        terms = TERM.findall(text)
        seen[lang].update(set(terms))
        used[lang, source].update(terms)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = {t for t, n in seen[lang].items() if n >= at_least}
        whole = Counter()
        for s in sources:
            whole.update({t: n for t, n in used[lang, s].items() if t in kept})

        def shares(counts):
            total = sum(n for t, n in counts.items() if t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(used[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = sorted(((sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "pair", o, f, k) for k, (f, o) in enumerate(pairs, 1)}
            more = sorted(((p[s][t] - q[t], t) for t in kept if used[lang, s][t] and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:ranks]
            out |= {(lang, s, "term", t, f, k) for k, (f, t) in enumerate(more, 1)}
    return out


def corpus():
    rng = random.Random(11)
    words = ["Straße", "été", "the", "th", "thesis", "a", "ab", "abc", "abcd", "abcde", "x" * 16, "x" * 17, "中文", "中", "it's", "B2B", "z z"] + [f"w{k}q" * (k % 9 + 1) for k in range(40)]
    rows = [(" ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 25))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S3", None, "ü"]))
            for _ in range(300)]
    rows += [(None, "en", "s1"), ("", "fr", "only"), ("... 123", "fr", "two"), ("lone " * 5000, "en", "s2"), ("long" * 50_000, "en", "s1")] + [rows[0]] * 9
    return rows


@pytest.mark.parametrize("at_least", [3, 30, 10_000])
def test_audit_equals_plain_counting(spark, at_least):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "text string, lang string, source string, n int, level string").repartition(3)
    got = divergence.audited(docs, at_least, ranks=4)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in got.collect()} == brute(rows, at_least, 4)


def test_tiles_blocks_and_batches_change_nothing(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(divergence, "_BLOCK_TERMS", 5)
    monkeypatch.setattr(divergence, "_TILE_SOURCES", 2)
    monkeypatch.setattr(divergence, "_SENT_ROWS", 3)
    assert {tuple(r) for r in divergence.audited(docs, 3, ranks=4).collect()} == brute(rows, 3, 4)


def test_blocks_may_meet_two_sources_either_way_round(spark, monkeypatch):
    """Half of the blocks get the rows of the sources in the other order."""
    monkeypatch.setattr(divergence, "_BLOCK_TERMS", 1)
    names = ["a", "b", "c"]
    groups = spark.createDataFrame([("en", s, 1, 40, 3) for s in names], "lang string, source string, base long, terms long, sources long").coalesce(1)
    rows = [("en", s, f"t{t}".encode(), 10 * k + 2) for t in range(40) for k, s in enumerate(names if t % 2 else names[::-1]) if t % 4 or s != "a"]
    shares = spark.createDataFrame(rows, "lang string, source string, piece binary, p long").coalesce(1)
    both = {}
    for order in (groups.orderBy("source"), groups.orderBy(F.desc("source"))):
        for r in divergence.pair_sums(order, shares.orderBy("piece", F.desc("source") if order is not groups else "source")).collect():
            both.setdefault((r.one, r.other), set()).add(r.value)
    assert both == {("a", "b"): {30 * 10 + 10 * 11}, ("a", "c"): {30 * 20 + 10 * 1}, ("b", "c"): {40 * 10}}
    turned = divergence._tile(pa.table({"lang": ["en"] * 4, "source": ["b", "a", "b", "a"], "tile": [0] * 4, "low": [0] * 4, "high": [0] * 4,
                                        "piece": pa.array([None, None, b"x", b"x"], pa.binary()), "p": [1, 1, 5, 9]}))
    assert turned.to_pylist() == [{"lang": "en", "one": "b", "other": "a", "value": 4}]


def test_prefixes_that_are_too_rare_are_not_extended(spark):
    """Ten terms with a common first half stay below the threshold alone: the half is kept on two levels, then all go."""
    docs = spark.createDataFrame([(f"shared{chr(97 + k % 10)}x kept", "en", "s") for k in range(60)], "text string, lang string, source string")
    counts = divergence.prefix_counts(docs)
    docs_of = {(r.level, r.whole): r.docs for r in counts.groupBy("level", "whole").agg(F.sum("docs").alias("docs")).collect()}
    assert docs_of == {(1, False): 120, (2, False): 60, (2, True): 60, (3, True): 60}
    assert [bytes(r.piece) for r in divergence.kept_terms(counts, 30).collect()] == [b"kept"]
    assert sorted(bytes(r.piece) for r in divergence.kept_terms(counts, 6).collect())[:2] == [b"kept", b"sharedax"]
    assert divergence.kept_terms(counts, 61).count() == 0


def test_no_documents(spark):
    assert divergence.audited(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
