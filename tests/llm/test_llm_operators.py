"""The operators against brute force on small tables, with null, empty, long, repeated and clashing rows."""

import hashlib
import io
import json
import random
import re
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import chatformat, decontaminate, htmltext, linededup, neardup, packing, quality, tokencounts, urlfilter, warc
from millrace.session import fresh_path

WORDS = ("the of and tion ing thresh inable ofered haing withed over one two three four five six seven eight nine "
         "river stone water light house garden winter summer market").split()
DOCS = "doc_id long, text string, lang string, bucket int, n_lines string, n_tokens int, component_id string"


def documents(spark, texts):
    """Rows with columns whose names clash with those that the operators make."""
    return spark.createDataFrame([(i, t, "en", 1, "x", 2, "y") for i, t in texts], DOCS)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def corpus(rng):
    base = [sentence(rng, 80) for _ in range(12)]
    out = list(base)
    for text in base[:6]:
        words = text.split()
        for changes in (1, 3, 6, 12):
            copy = list(words)
            for at in rng.sample(range(len(words)), changes):
                copy[at] = rng.choice(WORDS) + "x"
            out.append(" ".join(copy))
    out += [base[0], base[0].upper(), "", None, "one", "one", "two words", " \t\n", " ", sentence(rng, 20_000)]
    return [(None if k == 40 else k, t) for k, t in enumerate(out)]


# near duplicates

def brute_components(rows, words, percent):
    sets = {i: neardup.shingles_of(t, words) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    rows = corpus(random.Random(words))
    got = neardup.near_duplicates(documents(spark, rows), words=words).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == brute_components(rows, words, 80)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]


def test_outliers_of_a_bucket_lose_no_link(spark):
    """A family whose members differ so much from each other that one centre cannot link them all."""
    rng = random.Random(8)
    base, rows = [f"w{k}" for k in range(60)], []
    for k in range(60):
        copy = list(base)
        for at in rng.sample(range(60), rng.choice([1, 2, 3, 4, 5])):
            copy[at] = f"c{k}a{at}"
        rows.append((k, " ".join(copy)))
    got = neardup.near_duplicates(documents(spark, rows), words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_components(rows, 2, 80)


def test_signature_agreement_follows_similarity():
    orders, cache = neardup.visiting_orders(280), neardup._WordHashes()
    a = [b"%d" % k for k in range(300)]
    b = a[:240] + [b"x%d" % k for k in range(60)]
    one, two = (neardup.signature(neardup.shingle_hashes(w, 1, cache), orders) for w in (a, b))
    assert abs(float((one == two).mean()) - 240 / 360) < 0.1
    few, more = (neardup.signature(neardup.shingle_hashes(w, 1, cache), orders) for w in (a[:4], a[:5]))
    assert abs(float((few == more).mean()) - 0.8) < 0.1  # most bins are filled by densification


def test_no_documents(spark):
    none = documents(spark, [])
    assert neardup.near_duplicates(none).count() == 0
    assert linededup.deduplicated(none).count() == 0
    assert quality.judged(none).count() == 0 and quality.cleaned(none).count() == 0
    assert packing.packed(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert decontaminate.contaminated_spans(none, spark.createDataFrame([(1, "some benchmark text of many words")], "item_id long, text string")).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert warc.round_trip(pages).count() == 0 and htmltext.extracted(pages).count() == 0
    assert urlfilter.judged(pages, labels, []).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chatformat.read_back(chatformat.formatted(turns)).count() == 0


# decontamination

def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.random()
        if kind < 0.4:
            chars[at] = rng.choice("abcxyz")
        elif kind < 0.7:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcxyz"))
    return "".join(chars)


def least_edits(pattern, text):
    """Edits of the pattern against its best place in the text (Sellers)."""
    row = [0] * (len(text) + 1)
    for a in pattern:
        before, row = row, [row[0] + 1] + [0] * len(text)
        for j, b in enumerate(text, 1):
            row[j] = min(before[j - 1] + (a != b), before[j] + 1, row[j - 1] + 1)
    return min(row)


def test_decontamination_against_all_alignments(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PATTERN_CHARS", 120)
    rng = random.Random(5)
    items = [(k, sentence(rng, 14)) for k in range(12)] + [(90, None), (91, ""), (92, "too short")]
    rows = [(k, sentence(rng, 30) + " " + edited(rng, items[k % 12][1], k % 14).upper() + " " + sentence(rng, 25)) for k in range(48)]
    rows += [(100, None), (101, ""), (None, sentence(rng, 5) + items[3][1]), (103, "!" * 50 + items[4][1]), (104, items[5][1] + "\n" + items[6][1])]
    rows += [(105, " ".join(items[7][1].split()[:6]) + " " + sentence(rng, 60))]
    benchmark = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.contaminated_spans(documents(spark, rows), benchmark).collect()
    letters = decontaminate._letters()
    plain = lambda t: "".join(map(chr, decontaminate.normalized(t, letters)[0]))
    for doc_id, text in rows:
        mine = {(r.item_id, r.pattern): r for r in got if r.doc_id == doc_id}
        for item_id, item in items[:12]:
            for k, piece in enumerate(np.array_split(decontaminate.normalized(item, letters)[0], -(-len(plain(item)) // 120))):
                pattern = "".join(map(chr, piece))
                budget = min(len(pattern) // 10, len(pattern) // 8 - 1)
                best = least_edits(pattern, plain(text)) if text else 999
                assert ((item_id, k) in mine) == (best <= budget), (doc_id, item_id, best, budget)
                if best <= budget:
                    span = mine[item_id, k]
                    assert span.edits == best
                    assert least_edits(pattern, plain(text[span.start : span.end])) <= budget


def test_blocks_and_reads_change_nothing(spark, monkeypatch):
    rng = random.Random(6)
    items = [(k, sentence(rng, 20)) for k in range(9)]
    rows = [(k, sentence(rng, 200) + items[k % 9][1] + sentence(rng, 150)) for k in range(18)]
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, decontaminate.contaminated_spans(docs, benchmark).collect()))
    assert {(r[0], r[1]) for r in want} == {(k, k % 9) for k in range(18)}
    assert sorted(map(tuple, decontaminate.contaminated_spans(docs, benchmark, block_chars=200).collect())) == want
    letters = decontaminate._letters()
    monkeypatch.setattr(decontaminate, "READ_CHARS", 97)
    text = rows[0][1]
    whole, places = decontaminate.normalized(text, letters)
    seen = {}
    for codes, at in decontaminate._reads(text, letters, 60):
        seen.update(zip(at.tolist(), codes.tolist()))
    assert seen == dict(zip(places.tolist(), whole.tolist()))
    assert [c for *_, (c, _) in [decontaminate._reads('ab' + ' ' * 300 + 'cd', letters, 60)]][0].tolist() == [97, 98, 32, 99, 100]


# quality

def test_quality_measures_and_verdict(spark):
    rng = random.Random(1)
    good = "\n".join(sentence(rng, 25) for _ in range(6))
    menu = "\n".join(" | ".join(f"item{line}x{k}" for k in range(15)) for line in range(6))
    symbols = "\n".join(" ".join(w + "&&&" for w in rng.sample(WORDS, 20)) for _ in range(5))
    texts = [good, menu, symbols, good + "\nAll rights reserved.", good + "\n" + menu.split("\n")[0], None, "", "short text", " ", ("a b c " * 60), good + "\n" + good]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in quality.judged(documents(spark, rows)).collect()}
    for k, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = list(zip(words, words[1:], words[2:]))
        covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)} if len(words) < 400 else None
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[k]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        if covered is not None:
            assert r.n_repeat_words == len(covered)
        assert r.base_failed == (len(words) < 50 or 100 * r.n_repeat_words > 50 * len(words))
    assert [got[k].kept for k in range(5)] == [True, False, False, True, True]
    assert got[1].reason == "navigation" and got[2].reason == "symbols"
    assert "rights" not in got[3].cleaned and got[3].n_lines_removed == 1 and "|" not in got[4].cleaned
    assert {r.doc_id for r in quality.cleaned(documents(spark, rows)).collect()} == {k for k in got if got[k].kept}


# packing

def test_packing_keeps_every_id_and_fills_windows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    rng = random.Random(2)
    odd = ["a  b\tc\x85d <|endoftext|> e", "Σας ΑΣ. ´x ́y é", "don't I'LL 's, ... end.", "İstanbul ﬁ Ǆ ªº", None, "", "\n"]
    texts = odd + [sentence(rng, rng.randint(1, 900)) for _ in range(60)] + [sentence(rng, 9000)] * 2
    rows = list(enumerate(texts)) + [(None, "no id"), (3, texts[3])]
    got = packing.packed(documents(spark, rows), path).collect()
    for k, text in enumerate(texts):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        pieces = sorted({(r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got if r.doc_id == k})
        assert [p[0] for p in pieces] == list(np.cumsum([0] + [p[1] for p in pieces[:-1]]))
        assert sum(p[1] for p in pieces) == len(ids) // 4
        for start, length, crc, total in pieces:
            assert crc == zlib.crc32(ids[4 * start : 4 * (start + length)]) and total == len(ids) // 4
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-sum(r.length for r in got) // 4096) + 1


def test_subset_sums_against_all_choices():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(1, 60)
        chosen = packing.fullest(counts, room)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= room)
        assert all(k <= counts[n] for n, k in chosen.items())
    counts = {rng.randint(1, 4096): rng.randint(1, 50) for _ in range(300)}
    left = dict.fromkeys(counts, 0)
    for chosen, times in packing.bin_choices(counts):
        assert sum(n * k for n, k in chosen.items()) <= 4096
        for n, k in chosen.items():
            left[n] += k * times
    assert left == counts


# line dedup

def brute_lines(rows):
    seen, out = {}, []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    filled = {k: [(i, x.strip(" ")) for i, x in enumerate((rows[k][1] or "").split("\n")) if x.strip(" ")] for k in order}
    result = {}
    for k in order:
        gone = set()
        for p in range(len(filled[k]) - 2):
            window = tuple(t for _, t in filled[k][p : p + 3])
            if window in seen:
                gone |= {p, p + 1, p + 2}
            seen.setdefault(window, k)
        lines, keep = (rows[k][1] or "").split("\n"), []
        numbers = {i: p for p, (i, _) in enumerate(filled[k])}
        for i, x in enumerate(lines):
            if i in numbers:
                stays = numbers[i] not in gone
            else:
                before = [p for j, p in numbers.items() if j < i]
                after = [p for j, p in numbers.items() if j > i]
                stays = not gone or before and max(before) not in gone or after and min(after) not in gone
            if stays:
                keep.append(x)
        result[k] = None if rows[k][1] is None else "\n".join(keep)
    return result


def test_line_dedup(spark):
    rng = random.Random(7)
    pool = [f"line number {k} of the pool" for k in range(9)] + ["", "  "]
    rows = [(k, "\n".join(rng.choice(pool) + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 14)))) for k in range(60)]
    rows += [(60, None), (61, ""), (62, "\n\n"), (63, "\n".join(["same"] * 7)), (64, "\n".join(str(k % 3) for k in range(3000)))]
    rows.insert(5, (None, "\n".join(pool[:6])))
    got = {r.doc_id: r for r in linededup.deduplicated(documents(spark, rows)).collect()}
    want = brute_lines(rows)
    assert len(got) == len(rows)
    for k, (doc_id, text) in enumerate(rows):
        assert got[doc_id].text == want[k], doc_id
        assert got[doc_id].bucket == 1 and got[doc_id].lang == "en"
    assert got[63].text == "same" and got[63].n_lines_removed == 6


def test_line_dedup_of_passages_in_one_or_two_lines(spark):
    rng = random.Random(8)
    long = [" ".join(f"p{k}x{i}" for i in range(51)) for k in range(3)]
    half = [" ".join(f"h{k}x{i}" for i in range(26)) for k in range(3)]
    lines = long + half + [" ".join(f"s{i}" for i in range(50)), "a short line", "", "another"]
    rows = [(0, f"begin\n{long[0]}\nend"), (1, f"other\n {long[0]} \nwords"), (2, f"x\n{half[0]}\n{half[1]}\ny"), (3, f"z\n{half[0]}\n\n{half[1]}\nw"), (4, long[1]), (5, long[1]),
            (6, lines[6]), (7, lines[6]), (8, f"only\n{half[1]}")]
    rows += [(9 + k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 6)))) for k in range(60)]
    got = {r.doc_id: r for r in linededup.deduplicated(documents(spark, rows)).collect()}
    assert [got[k].text for k in range(9)] == [rows[0][1], "other\nwords", rows[2][1], "z\nw", long[1], "", lines[6], lines[6], rows[8][1]]
    seen = set()
    for doc_id, text in rows:
        filled = [x.strip(" ") for x in text.split("\n") if x.strip(" ")]
        gone = set()
        for p in range(len(filled)):
            for n in (1, 2, 3):
                window = tuple(filled[p : p + n])
                if len(window) == n and (n == 3 or len(" ".join(window).split()) > 50):
                    if window in seen:
                        gone |= set(range(p, p + n))
                    seen.add(window)
        assert [x.strip(" ") for x in got[doc_id].text.split("\n") if x.strip(" ")] == [x for p, x in enumerate(filled) if p not in gone], doc_id
        assert got[doc_id].n_lines_removed == len(gone)


# token counts

def test_token_counts_follow_edits(spark):
    files = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoding = tokencounts.Pieces(*files).encoding
    rng = random.Random(9)
    texts = [sentence(rng, rng.choice([1, 30, 600])) + "\n\n  it's 12 345" for _ in range(40)] + ["", "x" * 5000]
    lists = []
    for text in texts:
        edits = []
        for _ in range(rng.choice([0, 1, 2, 12])):
            at = rng.randint(0, len(text))
            edits.append((at, min(len(text), at + rng.choice([0, 1, 40])), rng.choice(["", " ", "'s", "word " * 300, "\n", "9"])))
        lists.append(edits)
    rows = [(k, t) for k, t in enumerate(texts)] + [(100, None), (None, "no id")]
    table = [(k, a, b, r) for k, edits in enumerate(lists) for a, b, r in edits] + [(0, -1, 2, "bad"), (0, 5, None, "bad"), (1, 0, 10**9, "bad")]
    edits = spark.createDataFrame(table, "doc_id long, start long, end long, replacement string")
    before = tokencounts.counted(documents(spark, rows), *files)
    got = {r.doc_id: r for r in tokencounts.recounted(tokencounts.with_edits(before, edits), *files).collect()}
    assert len(got) == len(rows) and got[100].n_tokens == 0 and got[0].bucket == 1
    at_once = tokencounts.recounted(tokencounts.with_edits(documents(spark, rows).drop("n_tokens"), edits), *files).collect()
    assert {(r.doc_id, r.n_tokens, r.n_tokens_before) for r in at_once} == {(r.doc_id, r.n_tokens, r.n_tokens_before) for r in got.values()}
    for k, text in enumerate(texts):
        new = tokencounts.edited(text, tokencounts.in_order(lists[k], len(text)))
        assert (got[k].text or "") == new and got[k].n_tokens == len(encoding.encode_ordinary(new)), k
        assert sum(got[k].tree.chars) == len(new) and sum(got[k].tree.tokens) == got[k].n_tokens
    long = sentence(rng, 5000)
    tree = tokencounts.Tree.of(long, tokencounts.Pieces(*files))
    edit = [(9000, 9003, "zz")]
    assert tokencounts.recount(tree, tokencounts.edited(long, edit), edit, tokencounts.Pieces(*files))[1] < 2000


def test_redactions(spark):
    texts = ["mail a.b@mail8.example.com, then 42.144.35.254 é 4041894974608795", "1234567890", "none", "", None, "x" * 20 + "deadbeefdeadbeef0"]
    got = {r.doc_id: r for r in tokencounts.redactions(documents(spark, list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        want = [(m.start(), m.end(), "[removed]") for m in re.finditer(tokencounts.PRIVATE, text or "")]
        assert [tuple(e) for e in got[k].edits or ()] == want, text


# urls

def test_url_rules_and_mined_rules(spark):
    pages = [(k, f"https://{'bad-shop' if k % 3 == 0 else 'good'}{k % 2}.example.net/{'buy' if k % 5 == 0 else 'read'}/{k}?ref={k % 4}") for k in range(300)]
    odd = [(1000, None), (1001, "no scheme"), (1002, "http://A.Example.ORG/es/1#x"), (1003, "http://notexample.org/es/"), (1004, "http://x.com/fr/"), (1005, "http://x.org"),
           (None, "https://bad-shop0.example.net/buy/7"), (0, pages[0][1])]
    labels = spark.createDataFrame([(k, 0 if k % 3 == 0 and k % 5 == 0 else 1, 0, 7) for k in range(280)] + [(None, 0, 1, 7), (5, None, None, 7)],
                                   "doc_id long, quality int, toxic int, page_id int")
    table = spark.createDataFrame([(i, u, "x") for i, u in pages + odd], "page_id long, url string, host string")
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow")]
    got = urlfilter.judged(table, labels, rules, least_pages=5, confidence=0.9).collect()
    assert len(got) == len(pages) + len(odd)
    for r in got:
        if r.page_id is not None and r.page_id < 300:
            assert r.verdict == ("block" if r.page_id % 15 == 0 else "allow"), r
    by = {r.page_id: r for r in got}
    assert (by[1000].host, by[1000].path) == ("", "") == (by[1001].host, by[1001].path)
    assert (by[1002].host, by[1002].path, by[1002].rule, by[1002].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (by[1003].rule, by[1003].verdict) == ("org/", "allow") and by[1004].rule == "com/fr/" and by[1005].rule is None
    assert by[None].verdict == "block"
    mined = urlfilter.mined_rules(urlfilter.labelled_items(table, labels), least_pages=5, confidence=0.9).collect()
    sets = [set(r.tokens) for r in mined]
    assert sets and not any(a < b for a in sets for b in sets)


# chat

def test_layouts_become_the_same_turns(spark):
    two = [("user", "Hi & <b>"), ("assistant", "Yes")]
    records = [
        {"messages": [{"role": r, "content": t} for r, t in two]}, {"conversations": [{"value": "Hi & <b>", "from": "human"}, {"from": "gpt", "value": "Yes"}]},
        {"response": "Yes", "prompt": "Hi & <b>"}, {"instruction": "Hi & <b>", "output": "Yes"}, {"instruction": "Hi & <b>", "input": None, "output": "Yes"},
        {"prompt": "Hi & <b>", "completion": "Yes"}, {"question": "Hi & <b>", "answer": "Yes"}, {"other": 1}, {"messages": "text"},
    ]
    rows = [(k, 0, json.dumps(r)) for k, r in enumerate(records)] + [(20, 0, None), (21, 0, "{broken")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, record string")
    got = {r.conv_id: r for r in chatformat.canonical(df).collect()}
    for k in range(7):
        assert [tuple(t) for t in got[k].turns] == two, records[k]
    assert all(got[k].layout is None and got[k].turns is None for k in (7, 8, 20, 21))


def test_chat_text_reads_back(spark):
    rng = random.Random(4)
    bits = ["<turn>", "</turn>\n", "<say>", "&lt;", "&amp;", "\\", "### Assistant:", "é", "\n", ""]
    turns = [(c, t, rng.choice(["user", "assistant", "a<b&", ""]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))) for c in range(20) for t in range(rng.randint(1, 9))]
    turns += [(50, t, "assistant" if t % 2 else "user", f"t{t} <") for t in range(700)] + [(None, 0, "user", "x"), (60, None, None, None), (60, 0, "assistant", None), (61, 1, "user", "tie"), (61, 1, "user", "tie")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, part int")
    got = {r.conv_id: r for r in chatformat.read_back(chatformat.formatted(df)).collect()}
    for c in {t[0] for t in turns}:
        mine = sorted(((-1 if t is None else t), r or "", x or "") for k, t, r, x in turns if k == c)
        assert got[c].n_turns == len(mine)
        assert got[c].turns_text == "".join(f"{r}\n{x}\n" for _, r, x in mine)
        assert got[c].loss_text == "".join(x for _, r, x in mine if r == "assistant")


# WARC

def test_warc_round_trip(spark):
    long_ = "é" * 600
    pages = [(1, "http://a/", long_), (2, "http://b/\r\nX: y", long_), (3, None, "short"), (4, "u", "short"), (5, "u", None), (None, "u", long_), (2, "again", long_), (6, "u", "x" * 300_000)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, digest string")
    got = warc.round_trip(df, with_payload=True).collect()
    assert len(got) == len(pages)
    for page_id, _, html in pages:
        payload = (html or "").encode()
        for r in (r for r in got if r.page_id == page_id):
            assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
            assert (r.record_type, r.refers_to) == (("revisit", 2) if page_id == 1 else ("response", None))
            assert r.payload == (None if page_id == 1 else html or "")


def test_archives_are_plain_zip_and_warc(spark):
    folder = fresh_path(spark, "zips")
    df = spark.createDataFrame([(k, f"http://h/{k}", "text " * (k + 1)) for k in range(40)], "page_id long, url string, html string").coalesce(1)
    manifest = warc.written(warc.deduplicated(df), folder, archive_bytes=1000).collect()
    assert sum(r.records for r in manifest) == 40 and len(manifest) > 3
    for row in manifest:
        store, place = warc._open(row.path)
        with store.open_input_file(place) as file:
            found = warc.members(file)
            whole = zipfile.ZipFile(io.BytesIO((file.seek(0), file.read())[1]))
        assert set(found) == set(whole.namelist()) == {warc.DATA, warc.INDEX}
        assert len(whole.read(warc.INDEX).split(b"\n")) == row.records
        assert found[warc.DATA][1] == len(whole.read(warc.DATA))


def test_zip64_directory():
    """A directory with ZIP64 records, as for more than 65535 members."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for k in range(65_600):
            archive.writestr(zipfile.ZipInfo(f"m{k}"), b"x")

    class Sized(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    found = warc.members(Sized(out.getvalue()))
    assert len(found) == 65_600
    at, length = found["m65599"]
    assert out.getvalue()[at : at + length] == b"x"


# pages

PAGE = ("<html><head><title>t</title><script>var a='</p>'</script></head><body class='has-sidebar'><header><h1>Site</h1></header>"
        "<div id='cookie-notice'>We use cookies</div><nav><a href=x>menu</a></nav>{body}<div class='x1'>Same on all</div>"
        "<div class='links'><a>more</a> <a>and more</a></div><aside>side</aside><form>Name</form><div class=comments><p>said</p></div><footer>&copy; f</footer></body></html>")


def test_pages_without_article_by_template(spark):
    rows = [(k, f"http://h.example.net/{k}", PAGE.format(body=f"<div class=content><h2>Title &amp; {k}</h2><p>First <b>bold</b> 1 < 2<br>line {k}<p>Second&nbsp;para {k}</div>")) for k in range(8)]
    rows += [(100, "http://one.example.net/", "<p>alone"), (101, None, None), (102, "x", ""), (None, "http://h.example.net/z", "<p>no id</p>"), (103, "http://s.example.net", "<!-- <p>never ends"),
             (104, "http://s.example.net/b", "<article><p>A<aside>x</aside><div class='ad'>buy</div><p>B</article><p>outside")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int")
    got = {r.page_id: r for r in htmltext.extracted(df).collect()}
    for k in range(8):
        assert got[k].text == f"Title & {k}\n\nFirst bold 1 < 2 line {k}\n\nSecond para {k}"
        assert got[k].n_chars == len(got[k].text)
    assert got[100].text == "alone" and got[101].text == "" == got[102].text == got[103].text
    assert got[104].text == "A\n\nB" and got[None].text == "no id"


def test_inline_elements_of_a_known_kind():
    """Only the inline run goes, wherever in its paragraph it stands."""
    for html, text in [
        ("<p><span class='share'>Share</span> long <b>bold</b> paragraph</p>", "long bold paragraph"),
        ("<p><button>Copy</button> text &amp; more</p>", "text & more"),
        ("<p>first <span class=ad>buy <i>now</i></span>last<span hidden>secret</span></p><p>next</p>", "first last\n\nnext"),
        ("<article><header><h1>Title <span class='share'>Share</span></h1><p>by me</p></header><p> <button>Copy</button> </p>body</article>", "Title\n\nbody"),
        ("<div class='ad'><p>all <b>of it</b></p></div><p>text", "text"),
    ]:
        assert htmltext.main_text(htmltext.Page(html), htmltext.Template(set(), set(), {}, set())) == text, html


def test_template_decides_beside_articles(spark):
    """Repeated notices and links in articles go; articles that are not the article of their host do not hide it."""
    body = lambda k, n=12: " ".join(f"w{k}x{i}" for i in range(n))
    rows, want = [], {}

    def add(host, html, text):
        rows.append((len(rows), f"http://{host}/{len(rows)}", html))
        want[rows[-1][0]] = text

    for k in range(6):
        # the same path as the paragraphs beside it, and a place of its own
        add("in.net", f"<article><h1>T {k}</h1><p>{body(k)}</p><p>Read our terms</p><p>{body(-k)}</p><div class=more><a>See this {k}</a></div><section class=x>Same</section></article>",
            f"T {k}\n\n{body(k)}\n\n{body(-k)}")
        add("teaser.net", f"<div class=text><p>{body(k, 40)}</p></div><article><p>teaser {k}</p></article><article><p>other {k}</p></article>",
            f"{body(k, 40)}\n\nteaser {k}\n\nother {k}")
        # the same pages under many places, and copies of a text with other words around it, are no template
        add("copy.net", f"<article><p>{body(1)}</p><p>{body(2)}</p></article>", f"{body(1)}\n\n{body(2)}")
        add("near.net", f"<article><p>{body(1)}</p><p>{body(2)}</p><p>end {k}</p></article>", f"{body(1)}\n\n{body(2)}\n\nend {k}")
        add("list.net", f"<main><ul><li><a>one {k}</a></li><li><a>two {k}</a></li></ul></main>", f"one {k}\n\ntwo {k}")
        add("plain.net", f"<article><p>{body(k)}</p></article><div class=z>part {k}</div>", body(k))
    got = {r.page_id: r.text for r in htmltext.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, text in want.items():
        assert got[k] == text, rows[k]
