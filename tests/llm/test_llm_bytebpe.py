"""Byte-level BPE against the tiktoken library, and UTF-8 against Python's decoder."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from millrace.llm import bytebpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["a", "b", "e", "th", "in", "ing", " ", "é", "ß", "中", "0", "1", ".", "aa", "\n", "😀", "the", "er", "'s", " ", "<|endoftext|>"]


def reference(ranks, pattern=PATTERN):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bytebpe.coder(PATH, PATTERN)


@pytest.fixture(scope="module")
def decoder():
    return bytebpe.decoder(PATH)


def test_same_ids_as_the_library(coder, decoder):
    plain, rng = reference(bytebpe.read_ranks(PATH)), random.Random(12)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 3000, "ab" * 2000, "é" * 999, "the" * 1000, "", " " * 500]
    for text, ids in zip(texts, coder.ids(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == plain.encode_ordinary(text)
        assert decoder.text(plain.encode_ordinary(text)) == text == "".join(decoder.parts(plain.encode_ordinary(text)))


def test_any_ranks():
    """Ranks that no training gives: tokens that no merge makes, merges that undo their order."""
    rng = random.Random(13)
    for _ in range(120):
        tokens = [bytes([b]) for b in range(256)] + list({bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(40)})
        rng.shuffle(tokens)
        ranks = {token: k for k, token in enumerate(tokens)}
        plain, own = reference(ranks, "[a-z]+"), bytebpe.Encoder(ranks)
        some = [bytes(rng.choices(b"abc", k=rng.randint(1, 60))) for _ in range(30)]
        assert [np.frombuffer(ids, "<i4").tolist() for ids in own.encode_many(some)] == [plain.encode_ordinary(t.decode()) for t in some]
        for _ in range(40):
            text = "".join(rng.choices("abc", k=rng.randint(1, 30)))
            assert own.encode(text.encode()) == plain.encode_ordinary(text)
            assert text.encode() in ranks or list(own.stream(bytes([b]) for b in text.encode())) == own.encode(text.encode())


def test_ids_are_told_after_bounded_lookahead(coder):
    """The stream of a long run of letters tells ids while it reads, never more than two tokens behind."""
    longest = max(len(t) for t in coder.encoder.merges.ranks)
    read = 0

    def parts():
        nonlocal read
        for byte in b"antidisestablishmentarianism" * 200:
            read += 1
            yield bytes([byte])

    told = 0
    for token in coder.encoder.stream(parts()):
        told += coder.encoder.sizes[token]
        assert read - told <= 2 * longest
    assert told == read


def test_states_are_bounded_by_the_vocabulary(coder):
    assert len(coder.encoder.places) <= len(coder.encoder.tree)
    with pytest.raises(ValueError):
        bytebpe.Encoder({b"a": 0})


def test_utf8_in_parts():
    rng = random.Random(14)
    for _ in range(3000):
        data = bytes(rng.choice([rng.randrange(256), 0xE4, 0xB8, 0xAD, 0xF0, 0x9F, 0xC3, 0x61]) for _ in range(rng.randint(0, 12)))
        decoder, cut = bytebpe.Utf8Decoder(), rng.randint(0, len(data))
        assert decoder.feed(data[:cut]) + decoder.feed(data[cut:]) + decoder.end() == data.decode("utf-8", "replace")


def test_decoder_steps_over_open_characters(coder, decoder):
    ids = [coder.encoder.merges.ranks[bytes([b])] for b in "a中😀é".encode() + b"\xe4\xb8"]
    assert decoder.text(ids) == "a中😀é�"


def test_only_rows_that_are_no_utf8_are_stepped_through(coder, decoder, monkeypatch):
    rows = ["a中😀é", "", "the end", "ü" * 50]
    ids = [np.frombuffer(one, "<i4").tolist() for one in coder.ids(rows)]
    byte = coder.encoder.merges.ranks
    broken = [byte[bytes([b])] for b in b"a\xe4\xb8"]
    given = pa.array([[5], *ids, None], pa.list_(pa.int32())).slice(1)
    stepped = []
    step_through = decoder.text
    monkeypatch.setattr(decoder, "text", lambda some: stepped.append(some) or step_through(some))
    assert decoder.texts(given).to_pylist() == [*rows, ""] and not stepped
    assert decoder.texts(pa.array([*ids, broken, None])).to_pylist() == [*rows, "a\ufffd", ""] and stepped == [broken]
    with pytest.raises(KeyError):
        bytebpe.Decoder({bytes([b]): 2 * b for b in range(256)}).texts(pa.array([[2], [3]]))


def test_rows(spark):
    texts = [(0, "The quick brown fox"), (1, None), (2, ""), (None, "no id"), (0, "The quick brown fox"), (3, "word " * 50_000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, ids int, n_tokens string")
    coded = bytebpe.encoded(docs, PATH, PATTERN)
    plain = reference(bytebpe.read_ranks(PATH))
    key = lambda r: (r[0] is None, r[0] or 0, len(r[1]))
    assert sorted([(r.doc_id, r.ids) for r in coded.collect()], key=key) == sorted([(i, plain.encode_ordinary(t or "")) for i, t in texts], key=key)
    assert sorted([(r.doc_id, r.text) for r in bytebpe.decoded(coded, PATH).collect()], key=key) == sorted([(i, t or "") for i, t in texts], key=key)
    assert bytebpe.decoded(bytebpe.encoded(docs.limit(0), PATH, PATTERN), PATH).count() == 0
