"""Chat records of any known layout as canonical turns, and turns as training text.

The layout of a record is the set of its nested field paths, without the types
of the values; its hash selects a declarative mapping to turns. Records may be
variants, JSON texts or structs of any shape.

Turns are written as ``<turn>role<say>text</turn>`` and a line end. ``&`` and
``<`` inside roles and texts are written ``&amp;`` and ``&lt;``, so no text can
hold a mark, and the original is read back by replacing the two again. Long
conversations are cut into parts of ``PART_TURNS`` turn numbers.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 256
TRAINED = "assistant"
TURNS = "array<struct<role:string,text:string>>"
#: Names of roles in other layouts. Fixed values.
ROLES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """A layout, shown by an example record, and where its turns are.

    ``single``: (role, paths) in order; the values of several paths are joined
    by an empty line, null and empty values are left out, and a turn without
    any value too. ``listed``: path of a list, and the names of role and text
    in its items. ``row``: the record is one turn, with the paths of role and text.
    """

    name: str
    example: dict
    single: tuple[tuple[str, tuple[str, ...]], ...] = ()
    listed: tuple[str, str, str] | None = None
    row: tuple[str, str] | None = None
    roles: dict[str, str] = field(default_factory=lambda: ROLES)

    def fingerprint(self) -> Column:
        return fingerprint(F.parse_json(F.lit(json.dumps(self.example))))

    def turns(self, record: Column) -> Column:
        text = lambda path: F.try_variant_get(record, path, "string")
        if self.row:
            return F.array(F.struct(_role(text(self.row[0]), self.roles).alias("role"), F.coalesce(text(self.row[1]), F.lit("")).alias("text")))
        if self.listed:
            path, role, said = self.listed
            items = F.try_variant_get(record, path, f"array<struct<`{role}`:string,`{said}`:string>>")
            return F.transform(items, lambda x: F.struct(_role(x[role], self.roles).alias("role"), F.coalesce(x[said], F.lit("")).alias("text")))
        turns = [F.struct(F.lit(role).alias("role"), F.array_join(F.filter(F.array(*map(text, paths)), lambda x: x != ""), "\n\n").alias("text")) for role, paths in self.single]
        return F.filter(F.array(*turns), lambda t: t["text"] != "")


def _role(name: Column, roles: dict[str, str]) -> Column:
    named = F.coalesce(name, F.lit(""))
    return reduce(lambda out, pair: out.when(named == pair[0], pair[1]), roles.items(), F.when(F.lit(False), "")).otherwise(named)


MAPPINGS = (
    Mapping("turn rows", {"role": "", "text": ""}, row=("$.role", "$.text")),
    Mapping("messages", {"messages": [{"role": "", "content": ""}]}, listed=("$.messages", "role", "content")),
    Mapping("from and value", {"conversations": [{"from": "", "value": ""}]}, listed=("$.conversations", "from", "value")),
    Mapping("prompt and response", {"prompt": "", "response": ""}, single=(("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Mapping("prompt and completion", {"prompt": "", "completion": ""}, single=(("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    Mapping("system, prompt and response", {"system": "", "prompt": "", "response": ""},
            single=(("system", ("$.system",)), ("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Mapping("instruction", {"instruction": "", "output": ""}, single=(("user", ("$.instruction",)), ("assistant", ("$.output",)))),
    Mapping("instruction with input", {"instruction": "", "input": "", "output": ""},
            single=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Mapping("question and answer", {"question": "", "answer": ""}, single=(("user", ("$.question",)), ("assistant", ("$.answer",)))),
)


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant; field order and value types do not matter."""
    return F.xxhash64(F.regexp_replace(F.schema_of_variant(record), r": (?!OBJECT<|ARRAY<)[A-Z]+(\([0-9, ]*\))?", ""))


def canonical(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds layout (name of the mapping, null for an unknown layout) and turns (``TURNS``, null likewise).

    ``record`` is a variant column, or a JSON text or struct that is made one.
    Text that is no JSON, and null, have no layout. Columns named layout and
    turns are replaced.
    """
    kind = dict(records.dtypes)[record]
    as_variant = F.col(record) if kind == "variant" else F.try_parse_json(record) if kind == "string" else F.to_variant_object(record)
    known = records.withColumn("_record", as_variant).withColumn("_print", fingerprint(F.col("_record")))
    name = reduce(lambda out, m: out.when(F.col("_print") == m.fingerprint(), m.name), mappings, F.when(F.lit(False), ""))
    turns = reduce(lambda out, m: out.when(F.col("layout") == m.name, m.turns(F.col("_record")).cast(TURNS)), mappings, F.when(F.lit(False), F.lit(None).cast(TURNS)))
    return known.withColumn("layout", name).withColumn("turns", turns).drop("_record", "_print")


def turn_rows(canonical_records: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of records with conv_id, turn (number of their first turn, null allowed) and turns."""
    return canonical_records.select("conv_id", "turn", F.posexplode("turns").alias("at", "t")).select(
        "conv_id", (F.col("turn") + F.col("at")).alias("turn"), "t.role", "t.text")


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def formatted(turns: DataFrame, trained: str = TRAINED) -> DataFrame:
    """(conv_id, part, formatted, loss_spans) of rows (conv_id, turn, role, text); parts in order make the conversation.

    Turns are ordered by number, then role and text; nulls come first. Null
    roles and texts are empty. ``loss_spans`` (start, length) are the code
    points of the texts of ``trained`` in ``formatted``. A null conv_id is a
    conversation of its own; a repeated row is a repeated turn.
    """
    role, text = (escaped(F.coalesce(c, F.lit(""))) for c in ("role", "text"))
    rows = turns.select("conv_id", F.floor(F.coalesce("turn", F.lit(-1)) / PART_TURNS).alias("part"), F.struct(
        F.col("turn"), role.alias("role"), text.alias("text")).alias("t"))
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    spans = F.expr(f"""
        aggregate(ts, named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,length:int>>)),
          (s, t) -> named_struct(
            'at', s.at + length(t.role) + length(t.text) + length('<turn><say></turn>') + 1,
            'spans', if(t.role = '{trained}',
              array_append(s.spans, named_struct('start', s.at + length(t.role) + length('<turn><say>'), 'length', length(t.text))), s.spans)),
          s -> s.spans)""")
    joined = F.expr("array_join(transform(ts, t -> '<turn>' || t.role || '<say>' || t.text || '</turn>\\n'), '')")
    return parts.select("conv_id", "part", joined.alias("formatted"), spans.alias("loss_spans"))


def read_back(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_text, loss_text, formatted_chars): turns and trained texts as read from the formatted text."""
    pieces = F.filter(F.split("formatted", "</turn>\n"), lambda x: x != "")
    read = F.transform(pieces, lambda p: F.concat(
        unescaped(F.substring_index(F.substr(p, F.lit(len("<turn>") + 1)), "<say>", 1)), F.lit("\n"),
        unescaped(F.substr(p, F.instr(p, "<say>") + len("<say>"))), F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    own = parts.select("conv_id", "part", read.alias("read"), F.array_join(loss, "").alias("loss"), F.length("formatted").alias("chars"))
    whole = own.groupBy("conv_id").agg(
        F.sum(F.size("read")).alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("part", F.array_join("read", "").alias("read"), "loss"))).alias("parts"))
    return whole.select("conv_id", "n_turns", F.array_join("parts.read", "").alias("turns_text"), F.array_join("parts.loss", "").alias("loss_text"), "formatted_chars")
