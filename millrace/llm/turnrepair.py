"""Cheapest repair of conversations by an auction for shortest paths.

The rows of a conversation and the last role of the repaired turns span a
lattice: keeping, rerolling or deleting a row goes to the next row, inserting a
turn stays. Prices are raised by the auction algorithm for shortest paths: a
path grows from its begin over arcs whose price difference is their cost, and
where there is none it raises the price of its end and draws back. Begins are
taken from the last row to the first, and a path ends at a place whose price has
converged, so each place is left after a few bids. The prices are then the costs
of what remains; arcs that meet their price difference are tight, and the
letters of a cheapest repair are traced over tight arcs, the least letter first,
from all places at once that spell the same letters.

Texts, order and repeats are handled in Spark with the rows of a conversation in
many tasks; a letter for each row (role and fault) meets in one row for the
auction, as does the answer, which has a letter for each row too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.common import Scratch
from millrace.operators.ordered import pin_sorted

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows whose texts meet in one array.
BLOCK = 256

#: Last role of the repaired turns (none, system, user, assistant) after one more role.
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_BLANKS = " \t\n\x0b\x0c\r"
_INITIALS, _FAULTS = "sua-", ("fine", "delete", "truncated")


def _arcs(initial: str, fault: str, state: int) -> tuple[tuple[int, str, int, int], ...]:
    """(cost, letter, rows passed, state after) of what can be done before or with a row."""
    out = [(INSERT, "I", 0, _AFTER[state, role]) for role in "ua" if (state, role) in _AFTER]
    if fault == "end":
        return (*out, (0, "", 1, 0)) if state in (0, 3) else tuple(out)
    out.append((DELETE, "D", 1, state))
    if fault != "delete":
        kept = TRUNCATED if fault == "truncated" else 0
        if (state, initial) in _AFTER:
            out.append((kept, "K", 1, _AFTER[state, initial]))
        out += [(kept + REROLE, "R", 1, _AFTER[state, role]) for role in "ua" if (state, role) in _AFTER]
    return tuple(out)


#: A letter for each initial and fault, and the arcs from each state before a row of that letter.
_LETTER = {(initial, fault): chr(65 + 3 * i + k) for i, initial in enumerate(_INITIALS) for k, fault in enumerate(_FAULTS)}
_ARCS = {letter: [_arcs(*kind, state) for state in range(4)] for kind, letter in _LETTER.items()}
_END = [_arcs("", "end", state) for state in range(4)]


def _bids(arcs: list, prices: list[int]) -> None:
    """Raise ``prices`` (four places for each row) until all are the costs of what remains."""
    exact = bytearray(len(prices))
    exact[4 * len(arcs)] = 1
    for begin in range(4 * len(arcs) - 1, -1, -1):
        path = [] if exact[begin] else [begin]
        while path:
            place = path[-1]
            row, state = divmod(place, 4)
            best, to = min((cost + prices[at], at) for cost, _, passed, after in arcs[row][state] for at in (4 * (row + passed) + after,))
            if prices[place] < best:
                prices[place] = best
                if len(path) > 1:
                    path.pop()
            elif exact[to]:
                break
            else:
                path.append(to)
        for place in path:
            exact[place] = 1


def _traced(arcs: list, prices: list[int]) -> str:
    """Least letters over tight arcs; places that spell the same letters stand at the same row and price."""
    places, out = {0}, []
    while True:
        tight: dict[str, set[int]] = {}
        for place in places:
            row, state = divmod(place, 4)
            for cost, letter, passed, after in arcs[row][state]:
                to = 4 * (row + passed) + after
                if prices[place] == cost + prices[to]:
                    tight.setdefault(letter, set()).add(to)
        letter = min(tight)
        if not letter:
            return "".join(out)
        out.append(letter)
        places = tight[letter]


def solve(letters: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of rows given by their letters; of equal costs the least audit."""
    arcs = [*map(_ARCS.__getitem__, letters), _END]
    prices = [0] * (4 * len(arcs) + 4)
    _bids(arcs, prices)
    return prices[0], _traced(arcs, prices)


_short = lru_cache(200_000)(solve)

_LEGAL = {"su", "ua", "au"}
_SOLVED = "conv_id {}, part int, block long, cost long, illegal long, audit string, place long, moves array<struct<edit:string,role:string,row:int>>"


def _plans(letters: list[str]) -> Iterator[tuple[int, int, str, int, list[dict]]]:
    """(cost, illegal, audit, first place, moves) of each block of a conversation; turns put in stand before the next row."""
    whole = "".join(letters)
    cost, audit = _short(whole) if len(whole) <= 64 else solve(whole)
    initials = [_INITIALS[(ord(x) - 65) // 3] for x in whole]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    odd = (len(audit) - audit.count("D")) % 2  # an odd number of turns begins with the system's
    place, at = 0, 0
    for number, block in enumerate(letters):
        first, row, begin, moves = place, 0, at, []
        while at < len(audit) and (row < len(block) or number == len(letters) - 1):
            edit = audit[at]
            at += 1
            if edit != "D":
                role = None if edit == "K" else "assistant" if (place - odd) % 2 else "user"
                moves.append({"edit": edit, "role": role, "row": None if edit == "I" else row})
                place += 1
            row += edit != "I"
        yield cost, illegal, audit[begin:at], first, moves


def _solved(blocks: DataFrame) -> DataFrame:
    """A row for each block of rows (conv_id, blocks), with what happens to its rows."""
    kind = dict(blocks.dtypes)["conv_id"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rows = []
            for conv_id, own in zip(batch.column("conv_id").to_pylist(), batch.column("blocks").to_pylist()):
                for block, (cost, illegal, audit, place, moves) in zip(own, _plans([b["letters"] for b in own])):
                    rows.append({"conv_id": conv_id, "part": block["part"], "block": block["block"], "cost": cost,
                                 "illegal": illegal, "audit": audit, "place": place, "moves": moves})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    moves = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("row", pa.int32())]))
    schema = pa.schema([("conv_id", to_arrow_type(blocks.schema["conv_id"].dataType)), ("part", pa.int32()), ("block", pa.int64()), ("cost", pa.int64()),
                        ("illegal", pa.int64()), ("audit", pa.string()), ("place", pa.int64()), ("moves", moves)])
    return blocks.mapInArrow(batches, _SOLVED.format(kind))


def met(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where null equals null; the keys of the left side stay."""
    other = right.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = reduce(lambda out, key: out & left[key].eqNullSafe(other[f"_{key}"]), keys, F.lit(True))
    return left.join(other, same, how).drop(*[f"_{key}" for key in keys])


def repaired(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Findings per conversation, and its repaired turns, of rows (conv_id, turn, role, text).

    Findings: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    Turns: conv_id, place (from 0), role, text, edit (K, R or I).

    Rows are taken by turn, role and text, nulls first; null roles and texts are
    one space. A null conv_id is a conversation of its own, and repeated rows are
    duplicates. Roles are known by their first letter. Empty texts are blank,
    texts of any length stay whole, other columns are ignored. No rows, no findings.
    """
    scratch = Scratch(turns.sparkSession, "turnrepair")
    filled = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    seen = F.right(F.rtrim("text", F.lit(_BLANKS)), F.lit(1))
    rows = pin_sorted(filled.withColumns({
        "last": seen, "mark": F.sha2(F.encode("text", "UTF-8"), 256),
        "initial": F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("-")}), ["conv_id", "turn", "role", "text"])
    light = rows.select("conv_id", "turn", "role", "mark", "last", "initial", F.struct("_part", "_pos").alias("at"))
    first = light.groupBy("conv_id", "role", "mark").agg(F.min("at").alias("first"))
    told = met(light, first, ["conv_id", "role", "mark"]).select("conv_id", "turn", "last", "initial", "at", (F.col("at") > F.col("first")).alias("again"))
    fault = (F.when(F.col("last") == "", "blank").when(F.col("again"), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated").otherwise("fine"))
    judged = scratch.pin(told.withColumn("fault", fault).drop("last", "again"))
    kind = F.when(F.col("fault").isin("blank", "duplicate"), "delete").otherwise(F.col("fault"))
    code = 65 + 3 * F.instr(F.lit(_INITIALS), F.col("initial")) - 3 + F.when(kind == "fine", 0).when(kind == "delete", 1).otherwise(2)
    block = F.floor(F.col("at._pos") / BLOCK).alias("block")
    letters = judged.groupBy("conv_id", F.col("at._part").alias("part"), block).agg(
        F.array_sort(F.collect_list(F.struct("at._pos", F.chr(code).alias("letter")))).alias("rows"))
    letters = letters.select("conv_id", "part", "block", F.array_join("rows.letter", "").alias("letters"))
    whole = letters.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "block", "letters"))).alias("blocks"))
    solved = scratch.pin(_solved(whole))
    audits = solved.groupBy("conv_id").agg(
        F.max("illegal").alias("illegal"), F.max("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("part", "block", "audit"))).alias("parts"))
    span = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1
    counts = judged.groupBy("conv_id", "turn").agg(*[F.sum((F.col("fault") == f).cast("long")).alias(f) for f in ("blank", "duplicate", "truncated")])
    counts = counts.groupBy("conv_id").agg(
        F.coalesce((span - F.count("turn")).cast("long"), F.lit(0).cast("long")).alias("gaps"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    findings = met(counts, audits, ["conv_id"]).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.array_join("parts.audit", "").alias("audit"))
    texts = rows.groupBy("conv_id", F.col("_part").alias("part"), F.floor(F.col("_pos") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "role", "text"))).alias("rows"))
    both = met(texts, solved, ["conv_id", "part", "block"]).select(
        "conv_id", "place", "rows", F.posexplode("moves").alias("step", "move"))
    own = F.get("rows", F.col("move.row"))
    out = both.select("conv_id", (F.col("place") + F.col("step")).alias("place"), F.coalesce("move.role", own["role"]).alias("role"),
                      F.when(F.col("move.edit") == "I", "").otherwise(own["text"]).alias("text"), F.col("move.edit").alias("edit"))
    return findings, out


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with the faults of a test: by a hash of conversation and turn, rows are dropped, emptied, cut off, repeated or given to the user."""
    filled = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = filled.withColumn("kind", F.crc32(F.encode(name, "UTF-8")) % 20).where("kind <> 0")
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), copies.alias("copy")).drop("copy")


def joined_hash(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): hash of ``role:text`` of all turns by place, joined by newlines."""
    line = F.concat("role", F.lit(":"), "text")
    parts = turns.groupBy("conv_id", F.floor(F.col("place") / BLOCK).alias("part")).agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("rows"))
    parts = parts.select("conv_id", "part", F.array_join("rows.line", "\n").alias("text"))
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("parts"))
    return whole.select("conv_id", F.sha2(F.encode(F.array_join("parts.text", "\n"), "UTF-8"), 256).alias("repaired_sha256"))
