"""Token counts that follow edits: a segment tree of pre-tokens per document.

The pre-tokens of a text are grouped into leaves; a node of the tree holds the
characters and tokens below it. Edits re-encode from the leaf that holds the
character before the edit until the new splitting meets an old leaf border
behind it. From there on nothing can differ, because the splitting looks one
character ahead and never back. New leaf values then change the sums on their
paths to the root.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 64  # pre-tokens in a leaf
_KNOWN_PIECES, _ROWS = 300_000, 500  # pre-tokens that a worker remembers; rows of an output batch
EDITS = "array<struct<start:long,end:long,replacement:string>>"
TREE = "struct<chars:array<long>,tokens:array<long>>"
_TREE_TYPE = pa.struct([("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])
#: What ``redactions`` replaces: mail addresses, long numbers and network addresses, long hexadecimal strings.
PRIVATE = r"(?<![\w.+-])[\w.+-]+@[\w-]+\.[\w.-]*\w|\d[\d.]{6,}\d|[0-9a-f]{16,}"


class Pieces:
    """Pre-tokens of a text and the tokens of each, remembered."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, int] = {}

    def tokens(self, pieces: list[str]) -> list[int]:
        known = self.known
        found = list(map(known.get, pieces))
        if None in found:
            if len(known) >= _KNOWN_PIECES:
                known.clear()
                known.update((p, n) for p, n in zip(pieces, found) if n is not None)
            new = list({p for p, n in zip(pieces, found) if n is None})
            known.update((p, len(self.encoding.encode_ordinary(p))) for p in new)
            found = list(map(known.__getitem__, pieces))
        return found


_LOADED: dict[tuple[str, str], Pieces] = {}


def _pieces(ranks: str, pattern: str) -> Pieces:
    if (ranks, pattern) not in _LOADED:
        _LOADED[ranks, pattern] = Pieces(ranks, pattern)
    return _LOADED[ranks, pattern]


class Tree:
    """Sums of characters and tokens; node 1 is the root, leaf k is node ``size + k``."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.leaves = len(chars)
        self.size = 1 << max(0, self.leaves - 1).bit_length()
        self.nodes = np.zeros((2 * self.size, 2), np.int64)
        self.nodes[self.size : self.size + self.leaves] = np.column_stack([chars, tokens])
        level = self.size
        while level > 1:
            self.nodes[level // 2 : level] = self.nodes[level : 2 * level : 2] + self.nodes[level + 1 : 2 * level : 2]
            level //= 2

    @classmethod
    def of(cls, text: str, pieces: Pieces) -> Tree:
        return cls(*_leaves(pieces.pattern.findall(text), pieces))

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = self.size + leaf
        change = np.array([chars, tokens]) - self.nodes[node]
        while node and change.any():
            self.nodes[node] += change
            node //= 2

    def leaf_values(self) -> tuple[np.ndarray, np.ndarray]:
        values = self.nodes[self.size : self.size + self.leaves]
        return values[:, 0], values[:, 1]

    @property
    def total(self) -> int:
        return int(self.nodes[1, 1])


def _leaves(found: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(0, len(found), LEAF)
    chars = np.fromiter(map(len, found), np.int64, len(found))
    return np.add.reduceat(chars, at), np.add.reduceat(np.array(pieces.tokens(found), np.int64), at)


def edited(text: str, edits: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for start, end, replacement in edits:
        out += (text[at:start], replacement)
        at = end
    return "".join((*out, text[at:]))


def in_order(edits: list[tuple[int, int, str]] | None, length: int) -> list[tuple[int, int, str]]:
    """Edits inside the text by place; one that overlaps an earlier one, or has a null, is left out."""
    out, at = [], 0
    for start, end, replacement in sorted(e for e in edits or () if None not in e):
        if at <= start <= end <= length:
            out.append((start, end, replacement))
            at = end
    return out


def recount(tree: Tree, new: str, edits: list[tuple[int, int, str]], pieces: Pieces) -> tuple[Tree, int]:
    """The tree of the edited text ``new`` and the number of characters encoded for it."""
    chars, _ = tree.leaf_values()
    borders = [0, *np.cumsum(chars).tolist()]
    changes, k, shift, encoded = [], 0, 0, 0
    while k < len(edits):
        first = max(0, bisect.bisect_right(borders, max(0, edits[k][0] - 2), 0, max(1, len(borders) - 1)) - 1)
        begin = at = borders[first] + shift
        found, reach = [], len(new) + 1
        for match in pieces.pattern.finditer(new, begin):
            at = match.end()
            found.append(match.group())
            while k < len(edits) and edits[k][0] + shift <= at:
                shift += len(edits[k][2]) - (edits[k][1] - edits[k][0])
                last = edits[k][1]
                k += 1
                reach = last + shift
            if at >= reach and (k == len(edits) or edits[k][0] - 2 > at - shift):
                after = bisect.bisect_left(borders, at - shift)
                if after < len(borders) and borders[after] == at - shift and after > first:
                    break
        else:  # the end of the text
            while k < len(edits):
                shift += len(edits[k][2]) - (edits[k][1] - edits[k][0])
                k += 1
            after = len(borders) - 1
        encoded += at - begin
        changes.append((first, max(after, first), found))
    grown = any(len(found) > 2 * LEAF * max(1, after - first) for first, after, found in changes)
    if grown or not tree.leaves:
        values, at = [], 0
        old = tree.leaf_values()
        for first, after, found in changes:
            values += [(old[0][at:first], old[1][at:first]), _leaves(found, pieces)]
            at = after
        values.append((old[0][at:], old[1][at:]))
        return Tree(np.concatenate([v[0] for v in values]), np.concatenate([v[1] for v in values])), encoded
    for first, after, found in changes:
        for leaf in range(first, after):
            part = found if leaf == first else []
            tree.set(leaf, sum(map(len, part)), sum(pieces.tokens(part)))
    return tree, encoded


def counted(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Adds n_tokens and tree (``TREE``, the leaves in order) to ``docs``; a null text counts as empty, with no leaves.

    All columns are kept; those named n_tokens and tree are replaced.
    """
    own = docs.drop("n_tokens", "tree")
    names = own.columns
    spot = names.index("text")

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(ranks, pattern)
        for batch in stream:
            totals, trees = [], []
            for text in batch.column(spot).to_pylist():
                chars, tokens = _leaves(pieces.pattern.findall(text or ""), pieces)
                totals.append(int(tokens.sum()))
                trees.append({"chars": chars, "tokens": tokens})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(totals, pa.int64()), pa.array(trees, _TREE_TYPE)], names=[*names, "n_tokens", "tree"])

    return own.mapInArrow(batches, _ddl(own, f"n_tokens long, tree {TREE}"))


def _ddl(df: DataFrame, more: str) -> str:
    return ", ".join([*(f"`{name}` {kind}" for name, kind in df.dtypes), more])


def recounted(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Applies the column ``edits`` (``EDITS``, offsets in code points) to text, tree and n_tokens; adds n_tokens_before and n_encoded.

    ``docs`` is a result of ``counted`` with that column; without the column
    tree, the tree is built first. Null edits are none. Edits apply in the order
    of their places; those outside the text, with a null in them, or overlapping
    an earlier one are left out. ``n_encoded`` is the number of characters that
    had to be encoded again.
    """
    made = ["n_tokens", "tree", "n_tokens_before", "n_encoded"]
    names = [c for c in docs.columns if c not in (*made, "edits")]
    at = {name: docs.columns.index(name) for name in docs.columns}
    ddl = _ddl(docs.select(names), f"n_tokens long, tree {TREE}, n_tokens_before long, n_encoded long")

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(ranks, pattern)
        for whole in stream:
            for batch in (whole.slice(k, _ROWS) for k in range(0, whole.num_rows, _ROWS)):
                texts, lists = batch.column(at["text"]).to_pylist(), batch.column(at["edits"]).to_pylist()
                stored = batch.column(at["tree"]).to_pylist() if "tree" in at else [None] * len(texts)
                before, after, trees, encoded = [], [], [], []
                for row, (text, edits, leaves) in enumerate(zip(texts, lists, stored)):
                    if leaves is None:
                        chars, tokens = _leaves(pieces.pattern.findall(text or ""), pieces)
                    else:
                        chars, tokens = (np.array(leaves[c], np.int64) for c in ("chars", "tokens"))
                    before.append(int(tokens.sum()))
                    edits = in_order([(e["start"], e["end"], e["replacement"]) for e in edits or ()], len(text or ""))
                    encoded.append(0)
                    if edits:
                        texts[row] = edited(text or "", edits)
                        tree, encoded[row] = recount(Tree(chars, tokens), texts[row], edits, pieces)
                        chars, tokens = tree.leaf_values()
                    after.append(int(tokens.sum()))
                    trees.append({"chars": chars, "tokens": tokens})
                kept = [pa.array(texts, pa.string()) if n == "text" else batch.column(at[n]) for n in names]
                new = [pa.array(after, pa.int64()), pa.array(trees, _TREE_TYPE), pa.array(before, pa.int64()), pa.array(encoded, pa.int64())]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[*names, *made])

    return docs.mapInArrow(batches, ddl)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with the column edits from a table (doc_id, start, end, replacement); as many per document as its text has places."""
    listed = edits.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "replacement")).alias("edits"))
    return docs.drop("edits").join(listed, "doc_id", "left")


def redactions(docs: DataFrame, private: str = PRIVATE, replacement: str = "[removed]") -> DataFrame:
    """``docs`` with the column edits that takes out what matches ``private``."""
    hits, gaps = F.regexp_extract_all("text", F.lit(private), F.lit(0)), F.split("text", private, -1)
    lengths = F.transform(F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(hits, F.length).alias("hit")), lambda p: p)
    placed = docs.drop("edits").withColumn("_lengths", lengths)
    found = F.expr(f"""
        aggregate(_lengths, named_struct('at', 0L, 'edits', cast(array() as {EDITS})),
          (s, p) -> named_struct('at', s.at + p.gap + coalesce(p.hit, 0), 'edits', if(p.hit is null, s.edits, array_append(s.edits,
            named_struct('start', s.at + p.gap, 'end', s.at + p.gap + p.hit, 'replacement', '{replacement}')))), s -> s.edits)""")
    return placed.withColumn("edits", found).drop("_lengths")
