"""Repair of conversations against all suffixes, and damage against zlib."""

import hashlib
import itertools
import random
import zlib

from millrace.llm import turnrepair

WHITE = " \t\n\x0b\x0c\r"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, audit, turns) of rows (role, text, fault), from the last row to the first: each state keeps its cheapest, then least, rest."""
    best = {}
    for at in range(len(rows), -1, -1):
        now = {s: (0, "", ()) for s in ("", "a")} if at == len(rows) else {}
        if at < len(rows):
            role, text, fault = rows[at]
            extra = 5 if fault == "truncated" else 0
            for state in ("", "s", "u", "a"):
                ways = [(2, "D", state, None)]
                if fault in ("fine", "truncated"):
                    ways += [(extra, "K", STEP.get((state, role[:1])), (role, text))]
                    ways += [(extra + 1, "R", STEP.get((state, r[0])), (r, text)) for r in ("user", "assistant")]
                found = [(c + best[to][0], e + best[to][1], (turn,) * (turn is not None) + best[to][2]) for c, e, to, turn in ways if to is not None and to in best]
                if found:
                    now[state] = min(found)
        for _ in range(3):  # turns put in before this row
            for state in ("", "s", "u", "a"):
                found = [now[state]] if state in now else []
                for r in ("user", "assistant"):
                    to = STEP.get((state, r[0]))
                    if to in now:
                        c, e, t = now[to]
                        found.append((c + 5, "I" + e, ((r, ""), *t)))
                if found:
                    now[state] = min(found)
        best = now
    return best[""]


def findings(turns):
    """Per conversation as the operator gives them, with the text of the repaired turns."""
    out = {}
    of = {}
    for c, turn, role, text in turns:
        of.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    for c, rows in of.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", "fine"), 0)
        for _, role, text in rows:
            core = text.rstrip(WHITE)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "fine" if core[-1] in ".!?" else "truncated"
            seen.add((role, text))
            n[fault] += 1
            judged.append((role, text, fault))
        ids = [t for t, _, _ in rows if t is not None]
        initials = [r[:1] for r, _, _ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, repaired = cheapest(judged)
        gaps = max(ids) - min(ids) + 1 - len(set(ids)) if ids else 0
        out[c] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, "\n".join(f"{r}:{t}" for r, t in repaired))
    return out


def compared(spark, turns):
    df = spark.createDataFrame([(*t, "x", 3) for t in turns], "conv_id long, turn long, role string, text string, place string, mark int").repartition(3)
    found, left = turnrepair.repaired(df)
    hashes = {r.conv_id: r.repaired_sha256 for r in turnrepair.joined_hash(left).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes.get(r.conv_id, empty)) for r in found.collect()}
    want = {c: (*v[:-1], hashlib.sha256(v[-1].encode()).hexdigest()) for c, v in findings(turns).items()}
    assert got == want


def test_prices_and_letters_against_suffixes():
    rng = random.Random(13)
    faults = {"fine": "fine", "delete": "blank", "truncated": "truncated"}
    for size in [0, 1, 2, 3, 5, 8, 13, 30] * 60:
        kinds = [(rng.choice(turnrepair._INITIALS), rng.choices(turnrepair._FAULTS, [6, 2, 2])[0]) for _ in range(size)]
        letters = "".join(turnrepair._LETTER[k] for k in kinds)
        cost, audit, _ = cheapest([(i, "", faults[f]) for i, f in kinds])
        assert turnrepair.solve(letters) == (cost, audit)


def test_conversations(spark):
    rng = random.Random(14)
    texts = ["Hello.", "What?", "Yes!", "cut off", "", " \t", None, "A ", "Fine. \n", "two\nlines.", "."]
    turns = []
    for c in range(120):
        for turn in range(rng.randint(1, 9)):
            turns.append((c, rng.choice([turn, turn, turn, 3, None, turn + 50]), rng.choice(["user", "assistant", "user", "assistant", "system", None, "tool", "", "User"]), rng.choice(texts)))
    turns += [(None, 0, "user", "No id."), (None, 1, "assistant", "Still."), (500, 0, "system", "x" * 300_000 + ".")]
    compared(spark, turns)


def test_a_conversation_over_many_blocks(spark):
    """One conversation with most rows, one turn number with many of them, and rows that repeat."""
    rng = random.Random(15)
    turns = [(1, k if k % 3 else 7, rng.choice(["user", "assistant"]), rng.choice([f"Text {k}.", "Same.", "cut"])) for k in range(1500)]
    compared(spark, turns + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hi!")] + [(3, 0, "user", "Hi.")] * 600)


def test_damage(spark):
    turns = [(c, t, r, x) for c in [*range(60), None] for t, r, x in [(0, "system", "Be kind."), (1, "user", "Why? Now!"), (None, "assistant", None)]]
    got = sorted(map(repr, (tuple(r) for r in turnrepair.damaged(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect())))
    want = []
    for c, t, r, x in turns:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = " " if x is None else x
        x = "" if kind == 1 else x.replace(".", "").replace("!", "").replace("?", "") if kind == 2 else x
        want += [(c, t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(map(repr, want))


def test_no_turns(spark):
    found, left = turnrepair.repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert found.count() == 0 and left.count() == 0
