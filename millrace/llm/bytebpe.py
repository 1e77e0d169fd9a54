"""Byte-level BPE as a transducer that is made deterministic as it meets text.

Merging by rank has one result for every beginning of a text, so its last token
is the one that ends there and agrees with the last token before it: no merge
over their border may come before the merges that made them. A state is the set
of places in the tree of token bytes where the bytes read so far may stand;
states and their steps are made when they are first met, at most one for each
place. A state names the tokens that may end in it, and registers hold the last
token at each place where a longer one may still have begun. What all of these
places share of the way to them is told: no further byte can change it.
Decoding steps from token to token with the part of a UTF-8 character that is
still open.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructType

#: Pairs of tokens, and pre-tokens of a generation, that a Python worker remembers; bytes after which a
#: long pre-token tells ids; most bytes of pre-tokens that go in step.
_PAIRS_KEPT, _PIECES_KEPT, _PART, _IN_STEP = 250_000, 150_000, 1024, 48
#: Bytes of text worked on together.
_TOGETHER = 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ranks, from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class Merges:
    """What rank-ordered merging (lowest rank first, then leftmost) does to single tokens and to pairs of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"no token for bytes {missing}")
        self._made: dict[int, list[tuple] | None] = {}
        self.known: dict[int, bool] = {}

    def _merged(self, rank: int) -> list[tuple] | None:
        """How the bytes of a token are merged: (rank of the next merge, first part, last part) before each merge and at the end.

        None if that does not give the token.
        """
        if rank not in self._made:
            parts, made = [bytes([b]) for b in self.tokens[rank]], []
            while len(parts) > 1:
                merges = [(self.ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
                if not merges:
                    break
                least, at = min(merges)
                made.append((least, parts[0], parts[-1]))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._made[rank] = [*made, (None, parts[0], parts[-1])] if len(parts) == 1 else None
        return self._made[rank]

    def reachable(self, rank: int) -> bool:
        return self._merged(rank) is not None

    def agree(self, first: int, second: int) -> bool:
        """Whether merging the bytes of two reachable tokens leaves just these two."""
        key = first << 32 | second
        if key not in self.known:
            if len(self.known) >= _PAIRS_KEPT:
                self.known.clear()
            self.known[key] = self._apart(self._merged(first), self._merged(second))
        return self.known[key]

    def _apart(self, left: list[tuple], right: list[tuple]) -> bool:
        i = j = 0
        while True:
            (of_left, _, a), (of_right, b, _) = left[i], right[j]
            over = self.ranks.get(a + b)
            # of equal ranks the merge further left comes first: one in the left token before the border, the border before the right token
            if over is not None and (of_left is None or over < of_left) and (of_right is None or over <= of_right):
                return False
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and of_left <= of_right):
                i += 1
            else:
                j += 1


class Encoder:
    """Ids of pre-tokens, byte by byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self.tree: list[dict[int, int]] = [{}]
        self.token_at: list[int | None] = [None]
        self.depth = [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                child = self.tree[node].get(byte)
                if child is None:
                    child = self.tree[node][byte] = len(self.tree)
                    self.tree.append({})
                    self.token_at.append(None)
                    self.depth.append(self.depth[node] + 1)
                node = child
            self.token_at[node] = rank
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.size_of = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size_of[list(self.sizes)] = list(self.sizes.values())
        self.numbers: dict[tuple[int, ...], int] = {(0,): 0}
        self.places: list[tuple[int, ...]] = [(0,)]  # the longest first
        self.steps: list[dict[int, int]] = [{}]
        self.ends: list[tuple[tuple[int, int], ...]] = [()]  # (bytes, token), the longest first
        self.table, self.end_at = np.full((1024, 256), -1, np.int32), np.full((1024, 8, 2), -1, np.int64)  # steps and ends as arrays

    def _step(self, state: int, byte: int) -> int:
        """Make the step from a state by a byte."""
        places = (*(child for node in self.places[state] if (child := self.tree[node].get(byte))), 0)
        after = self.numbers.get(places)
        if after is None:
            after = self.numbers[places] = len(self.places)
            tokens = ((self.depth[node], self.token_at[node]) for node in places)
            self.places.append(places)
            self.steps.append({})
            self.ends.append(tuple((size, token) for size, token in tokens if token is not None and self.merges.reachable(token)))
        self.steps[state][byte] = after
        return after

    def _way(self, last: list[int | None], at: int, stop: int = 0) -> list[int]:
        """Tokens from ``stop`` up to ``at``."""
        out = []
        while at > stop:
            out.append(last[at])
            at -= self.sizes[last[at]]
        return out[::-1]

    def _settled(self, state: int, last: list[int | None]) -> int:
        """Up to where the ways to all places at which a further token may begin are the same."""
        ats = {len(last) - 1 - self.depth[node] for node in self.places[state] if self.tree[node]}
        while len(ats) > 1:
            far = max(ats)
            ats.remove(far)
            ats.add(far - self.sizes[last[far]])
        return ats.pop()

    def stream(self, parts: Iterable[bytes]) -> Iterator[int]:
        """Ids of one text whose bytes come in parts; ids are told as soon as a part settles them."""
        state, last, steps, ends, agree = 0, [None], self.steps, self.ends, self.merges.agree
        for part in parts:
            for at, byte in enumerate(part, len(last)):
                state = steps[state].get(byte) or self._step(state, byte)
                for size, token in ends[state]:
                    before = last[at - size]
                    if before is None or agree(before, token):
                        last.append(token)
                        break
            if settled := self._settled(state, last):
                yield from self._way(last, settled)
                del last[:settled]
        yield from self._way(last, len(last) - 1)

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. A pre-token that is a token in whole is that token, even if no merge makes it."""
        if len(piece) > 1 and piece in self.merges.ranks and not self.merges.reachable(self.merges.ranks[piece]):
            return [self.merges.ranks[piece]]
        return list(self.stream(piece[at : at + _PART] for at in range(0, len(piece), _PART)))

    def _moved(self, states: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """States after a byte for each of many pre-tokens."""
        after = self.table[states, bytes_]
        for pair in np.unique(states[after < 0] << 8 | bytes_[after < 0]).tolist():
            state, byte = pair >> 8, pair & 255
            to = self.steps[state].get(byte) or self._step(state, byte)
            if to >= len(self.table):
                grown = len(self.table)
                self.table = np.concatenate([self.table, np.full((grown, 256), -1, np.int32)])
                self.end_at = np.concatenate([self.end_at, np.full((grown, *self.end_at.shape[1:]), -1, np.int64)])
            if len(self.ends[to]) > self.end_at.shape[1]:
                wider = len(self.ends[to]) - self.end_at.shape[1]
                self.end_at = np.concatenate([self.end_at, np.full((len(self.end_at), wider, 2), -1, np.int64)], axis=1)
            self.table[state, byte] = to
            self.end_at[to, : len(self.ends[to])] = self.ends[to]
        return self.table[states, bytes_]

    def _agreed(self, firsts: np.ndarray, seconds: np.ndarray) -> np.ndarray:
        pairs, place = np.unique(firsts << 32 | seconds, return_inverse=True)
        known, agree = self.merges.known.get, self.merges.agree
        told = [agree(pair >> 32, pair & 0xFFFFFFFF) if (one := known(pair)) is None else one for pair in pairs.tolist()]
        return np.array(told, bool)[place]

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (four bytes each) of many pre-tokens, a step of all of them at a time; long ones go one by one."""
        out = [np.array(self.encode(piece), "<i4").tobytes() if len(piece) > _IN_STEP else b"" for piece in pieces]
        order = sorted((k for k, piece in enumerate(pieces) if 0 < len(piece) <= _IN_STEP), key=lambda k: -len(pieces[k]))
        if not order:
            return out
        sizes = np.array([len(pieces[k]) for k in order])
        text = np.frombuffer(b"".join(pieces[k].ljust(_IN_STEP, b"\0") for k in order), np.uint8).reshape(-1, _IN_STEP)
        last, states = np.full((len(order), _IN_STEP + 1), -1, np.int32), np.zeros(len(order), np.int64)
        for at in range(int(sizes[0])):
            n = int(np.searchsorted(-sizes, -at))  # those with a byte here; the longest stand first
            states[:n] = self._moved(states[:n], text[:n, at].astype(np.int64))
            open_, rank = np.arange(n), 0
            while len(open_):
                size, token = self.end_at[states[open_], rank].T
                prior = last[open_, at + 1 - size].astype(np.int64)
                fits = prior < 0
                fits[~fits] = self._agreed(prior[~fits], token[~fits])
                last[open_[fits], at + 1] = token[fits]
                open_, rank = open_[~fits], rank + 1
        ats, rows, found = sizes.copy(), np.arange(len(order)), []
        while len(rows):
            tokens = last[rows, ats[rows]]
            found.append((rows, tokens))
            ats[rows] -= self.size_of[tokens]
            rows = rows[ats[rows] > 0]
        row = np.concatenate([r for r, _ in found[::-1]])
        ids = np.concatenate([t for _, t in found[::-1]])[np.argsort(row, kind="stable")].astype("<i4").tobytes()
        ends = np.cumsum(4 * np.bincount(row, minlength=len(order))).tolist()
        for k, begin, end in zip(order, [0, *ends], ends):
            whole = end - begin > 4 and self.merges.ranks.get(pieces[k])
            out[k] = ids[begin:end] if whole in (False, None) else np.array([whole], "<i4").tobytes()
        return out


#: Lead bytes of UTF-8 to the number of bytes that follow and the bounds of the first of them; fixed values of the format.
_FOLLOW = ((0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F),
           (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F))
_LEADS = {lead: row[2:] for row in _FOLLOW for lead in range(row[0], row[1] + 1)}


class Utf8Decoder:
    """Text of bytes that come in parts; a part of a character waits for the rest.

    Bytes that are no UTF-8 become U+FFFD, one for each longest beginning of a character.
    """

    def __init__(self):
        self.open = b""

    @staticmethod
    def step(open_: bytes, part: bytes) -> tuple[bytes, str]:
        """(bytes that wait, text) after ``part``, with ``open_`` waiting before it."""
        out, held = [], open_
        for byte in part:
            if held:
                follow, low, high = _LEADS[held[0]]
                if len(held) > 1:
                    low, high = 0x80, 0xBF
                if low <= byte <= high:
                    held += bytes([byte])
                    if len(held) == follow + 1:
                        out.append(held.decode())
                        held = b""
                    continue
                out.append("�")
                held = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif byte in _LEADS:
                held = bytes([byte])
            else:
                out.append("�")
        return held, "".join(out)

    def feed(self, part: bytes) -> str:
        self.open, text = self.step(self.open, part)
        return text

    def end(self) -> str:
        left, self.open = self.open, b""
        return "�" if left else ""


class Decoder:
    """Text of ids, token by token; steps are kept per open bytes and token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.steps = {b"": {rank: Utf8Decoder.step(b"", token) for rank, token in self.tokens.items()}}
        #: texts of the tokens that leave no character open when none is
        self.closed = {rank: text for rank, (open_, text) in self.steps[b""].items() if not open_}
        self.bytes_at = pa.array(map(self.tokens.get, range(max(self.tokens) + 1)), pa.binary())

    def parts(self, ids: Iterable[int]) -> Iterator[str]:
        """Text told by each token in turn, and at the end."""
        open_ = b""
        for token in ids:
            open_, text = self._step(open_, token)
            yield text
        if open_:
            yield "\ufffd"

    def _step(self, open_: bytes, token: int) -> tuple[bytes, str]:
        steps = self.steps.setdefault(open_, {})
        made = steps.get(token)
        if made is None:
            made = steps[token] = Utf8Decoder.step(open_, self.tokens[token])
        return made

    def text(self, ids: list[int]) -> str:
        texts, at = list(map(self.closed.get, ids)), -1
        for _ in range(texts.count(None)):  # a token that ends within a character: step on until none is open
            try:
                at = texts.index(None, at + 1)
            except ValueError:
                break
            open_, texts[at] = self._step(b"", ids[at])
            while open_ and at + 1 < len(ids):
                at += 1
                open_, texts[at] = self._step(open_, ids[at])
            if open_:
                texts.append("\ufffd")
        return "".join(texts)

    def texts(self, ids: pa.ListArray) -> pa.StringArray:
        """Text of each list of ids; null ids are no ids. Only rows whose bytes are no UTF-8 are stepped through."""
        ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(ids), 0).to_pylist()])
        tokens = self.bytes_at.take(ids.flatten())
        rows = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens), b"")
        try:
            if not rows.null_count:
                return rows.cast(pa.string())
        except pa.ArrowInvalid:
            pass
        return pa.array((self._read(row.as_py(), some) for row, some in zip(rows, ids)), pa.string())

    def _read(self, row: bytes | None, ids: pa.ListScalar) -> str:
        try:
            return row.decode()
        except (AttributeError, UnicodeDecodeError):
            return self.text(ids.as_py())


class Coder:
    """Ids of texts, cut into pre-tokens by a pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.encoder, self.cut = Encoder(ranks), regex.compile(pattern)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _meet(self, pieces: set[str]) -> None:
        """Make ids of all ``pieces`` known; a full generation of known ones becomes the old one."""
        if len(self.young) >= _PIECES_KEPT:
            self.old, self.young = self.young, {}
        young = self.young
        missing = {piece for piece in pieces if piece not in young}
        again = self.old.keys() & missing
        self.young.update((piece, self.old[piece]) for piece in again)
        new = list(missing - again)
        self.young.update(zip(new, self.encoder.encode_many([piece.encode() for piece in new])))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, four bytes each."""
        cut = [self.cut.findall(text or "") for text in texts]
        self._meet(set().union(*cut))
        return [b"".join(map(self.young.__getitem__, pieces)) for pieces in cut]


#: Coders and decoders of this Python worker, for all of its tasks.
_KEPT: dict[tuple, Coder | Decoder] = {}


def coder(path: str, pattern: str) -> Coder:
    return _KEPT.get((path, pattern)) or _KEPT.setdefault((path, pattern), Coder(read_ranks(path), pattern))


def decoder(path: str) -> Decoder:
    return _KEPT.get((path,)) or _KEPT.setdefault((path,), Decoder(read_ranks(path)))


def _runs(sizes: Iterable[int]) -> Iterator[tuple[int, int]]:
    """(begin, number) of rows of together about ``_TOGETHER`` bytes."""
    begin, at, held = 0, 0, 0
    for at, size in enumerate(sizes, 1):
        held += size
        if held >= _TOGETHER:
            yield begin, at - begin
            begin, held = at, 0
    if at > begin:
        yield begin, at - begin


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text); a null or empty text has no ids. Other columns are ignored."""
    kind = docs.schema["doc_id"].dataType

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in stream:
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            for begin, number in _runs(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                found = own.ids(texts.slice(begin, number).to_pylist())
                ends = np.cumsum([0, *map(len, found)]) // 4
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(begin, number), ids], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(batches, StructType().add("doc_id", kind).add("ids", ArrayType(IntegerType())))


def decoded(rows: DataFrame, path: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids), with columns to ``keep``; null ids are no ids. Other columns are ignored."""
    given = rows.select("doc_id", "ids", *[value.alias(name) for name, value in (keep or {}).items()])
    schema = StructType([*(field for field in given.schema if field.name != "ids")]).add("text", "string")
    names = [field.name for field in schema[:-1]]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path)
        for batch in stream:
            ids = batch.column("ids")
            for begin, number in _runs(4 * n for n in pc.fill_null(pc.list_value_length(ids), 0).to_pylist()):
                kept = [batch.column(name).slice(begin, number) for name in names]
                yield pa.RecordBatch.from_arrays([*kept, own.texts(ids.slice(begin, number))], names=[*names, "text"])

    return given.mapInArrow(batches, schema)
