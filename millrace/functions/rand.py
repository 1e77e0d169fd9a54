"""Reproducible sample values: each is a pure function of a seed and row keys.

``rand()`` depends on how rows are spread over partitions; hashing the key
gives the same value on one core or on a thousand executors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions.md5 import Numbered

# Symbols of the generated texts.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 "


def uniform(seed: int, *keys: Column, portable: bool = False) -> Column:
    """Uniform double in [0, 1).

    The default hashes with ``xxhash64``. ``portable=True`` uses the first 52
    bits of an MD5 over the joined keys, which other SQL engines have as well.
    """
    if portable:
        text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
        bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
        return bits / F.lit(float(1 << 52))
    hashed = F.xxhash64(F.lit(seed), *keys).bitwiseAND(F.lit((1 << 52) - 1))
    return hashed / F.lit(float(1 << 52))


def random_between(u: Column, lo: float, hi: float, round_to: int = 0) -> Column:
    """A value between the bounds: floor when ``round_to`` is 0, else rounded."""
    value = u * F.lit(float(lo - hi)) + F.lit(float(hi))
    return F.floor(value).cast("bigint") if round_to == 0 else F.round(value, round_to)


def _gate(u: Column, lo: int, hi: int) -> tuple[Column, Column]:
    size = F.floor(u * F.lit(float(hi - lo)) + F.lit(float(lo))).cast("int")
    return size, (size % 5) > 1


#: Symbols that one hash gives, of 16 bits each.
DRAWS = 8


def _drawn(seed: int, *keys: Column, size: Column) -> Column:
    """Hex digits for ``size`` draws: hashes of the keys with 0, 1, 2, ... behind them; draw i has digits 4 i to 4 i + 3."""
    stem = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys], F.lit(""))
    hashes = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / DRAWS)), lambda n: F.md5(F.concat(stem, n.cast("string"))))
    return F.array_join(hashes, "")


@F.arrow_udf(StringType())
def _each_drawn(stem: pa.Array, size: pa.Array) -> pa.Array:
    """Texts of ``size`` symbols; symbol i is the uniform value of the stem with i behind it."""
    sizes = np.maximum(size.to_numpy(zero_copy_only=False), 0)
    longest = int(sizes.max(initial=0))
    texts, symbols = Numbered(stem, len(str(longest))), np.frombuffer(SYMBOLS.encode(), dtype=np.uint8)
    out = np.zeros((len(sizes), longest), dtype=np.uint8)
    for i in range(longest):
        rows = np.flatnonzero(sizes > i)
        u = (texts.hashes(rows, i + 1).view(">u8")[:, 0] >> np.uint64(12)) / float(1 << 52)
        out[rows, i] = symbols[(u * float(len(SYMBOLS))).astype(np.int64)]
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = out[np.arange(longest) < sizes[:, None]]
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(data))


def random_text(seed: int, *keys: Column, lo: int = 0, hi: int = 50, gated: bool = True,
                portable: bool = False, draws: int = DRAWS) -> Column:
    """Text of ``lo`` to ``hi - 1`` symbols; with ``gated`` some rows stay empty.

    ``portable=True`` takes eight symbols from one MD5, or with ``draws=1`` the
    uniform value of its own MD5 for each.
    """
    if draws not in (1, DRAWS):
        raise ValueError(f"a hash gives 1 or {DRAWS} symbols")
    size, open_gate = _gate(uniform(seed, *keys, portable=portable), lo, hi)
    symbols = len(SYMBOLS)

    def picked(place: Column) -> Column:
        return F.substring(F.lit(SYMBOLS), place.cast("int") + 1, F.lit(1))

    if portable and draws == 1:
        stem = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys], F.lit(""))
        word = _each_drawn(stem, F.when(open_gate, size).otherwise(0) if gated else size)
    elif portable:
        digits = F.split(F.regexp_replace(_drawn(seed, *keys, size=size), "(.{4})", "$1 "), " ", -1)
        word = F.array_join(F.transform(F.slice(digits, 1, size), lambda d: picked(F.floor(F.conv(d, 16, 10).cast("int") * symbols / 65536))), "")
    else:
        word = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: picked(F.floor(uniform(seed, *keys, i) * F.lit(float(symbols))))), "")
    filled = (size >= 1) & open_gate if gated else size >= 1
    return F.when(filled, word).otherwise(F.lit(""))


def random_json(seed: int, *row_keys: Column, keys: list[str] = ("a", "b", "c"), lo: int = 0, hi: int = 10,
                portable: bool = False) -> Column:
    """JSON object of random integers; NULL for the rows that the gate closes."""
    _, open_gate = _gate(uniform(seed, *row_keys, portable=portable), lo, hi)
    fields = [
        random_between(uniform(seed, *row_keys, F.lit(k), portable=portable), lo, hi).alias(k) for k in keys
    ]
    return F.when(open_gate, F.to_json(F.struct(*fields)))
