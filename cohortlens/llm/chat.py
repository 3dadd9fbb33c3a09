"""Operator 7: chat formatting with schema fingerprints (native).

Records come as JSON of any known layout. A record's nested field paths, types left out, are
hashed; the fingerprint selects a declarative mapping that yields canonical turns (role,
text). A mapping names either one list of messages, or single fields in turn order:

    ListLayout("messages", "role", "content")          {"messages": [{"role", "content"}]}
    FieldLayout([("user", "prompt"), ...])              {"prompt": ..., "response": ...}

Turns are written with a template that marks roles and ends; control strings (and the escape
sign) inside texts get an escape sign after their first character, so no control string is
left inside a text and removing the signs restores it. Every text under the loss mask is a
segment of its own. ``read_back`` parses the formatted string again.

DataFrame functions only: variants, higher-order functions and regular expressions.

JSON readers refuse very long strings and variants very large values, so a record may leave its
texts outside: ``texts`` is an array, and a text in the record that starts with ``REF`` names its
place there. ``to_records`` does so for all texts of a record that holds over ``INLINE`` characters,
or any text that itself starts with ``REF``.

Defined results: null text and null role are empty; turns of one number are ordered by role
and text, and repeated rows are turns each; a null conversation id is one conversation; texts of any
length are kept whole; an unknown layout or malformed JSON gives layout 'unknown' and null turns
(a record written by ``to_records`` that should not parse raises); an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESC = "\\"
#: FIXED VALUES: control strings of the template
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ALIASES = {"human": "user", "gpt": "assistant"}
TURNS = "array<struct<role:string,text:string>>"
REF = "\u0001text:"    # a text kept outside its record: REF and its place in ``texts``
INLINE = 1_000_000    # characters of texts that a record may hold itself


# ------------------------------------------------------------------ layouts
@dataclass(frozen=True)
class ListLayout:
    """Turns are the items of one list; ``aliases`` renames roles."""

    path: str
    role: str
    text: str
    aliases: dict = field(default_factory=dict)

    def paths(self) -> list[str]:
        items = ", ".join(sorted([self.role, self.text]))
        return [f"OBJECT<{self.path}: ARRAY<OBJECT<{items}>>>", f"OBJECT<{self.path}: ARRAY>"]

    def turns(self, record: Column) -> Column:
        items = F.variant_get(record, f"$.{self.path}", f"array<struct<{self.role}:string,{self.text}:string>>")

        def canonical(x):
            role = F.coalesce(x[self.role], F.lit(""))
            renamed = role
            for old, new in self.aliases.items():
                renamed = F.when(role == old, F.lit(new)).otherwise(renamed)
            return F.struct(renamed.alias("role"), F.coalesce(x[self.text], F.lit("")).alias("text"))
        return F.transform(items, canonical)


@dataclass(frozen=True)
class FieldLayout:
    """Turns are single fields, in the order given: (role, path)."""

    fields: tuple[tuple[str, str], ...]

    def paths(self) -> list[str]:
        return ["OBJECT<" + ", ".join(sorted(p for _, p in self.fields)) + ">"]

    def turns(self, record: Column) -> Column:
        return F.array(*[F.struct(F.lit(role).alias("role"),
                                  F.coalesce(F.variant_get(record, f"$.{p}", "string"), F.lit("")).alias("text"))
                         for role, p in self.fields])


LAYOUTS = {
    "messages": ListLayout("messages", "role", "content"),
    "from_value": ListLayout("conversations", "from", "value", ALIASES),
    "prompt_response": FieldLayout((("user", "prompt"), ("assistant", "response"))),
    "system_prompt_response": FieldLayout((("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    "instruction_output": FieldLayout((("user", "instruction"), ("assistant", "output"))),
}


def field_paths(record: Column) -> Column:
    """Nested field names of a variant without its types."""
    shape = F.schema_of_variant(record)
    return F.regexp_replace(F.regexp_replace(shape, r"ARRAY<(?!OBJECT|ARRAY)[A-Z0-9(), ]*>", "ARRAY"),
                            r": (?!OBJECT|ARRAY)[A-Z]+(\([0-9, ]*\))?", "")


def fingerprint(paths: Column) -> Column:
    return F.sha2(paths, 256)


def _outside(turn: Column, texts: Column) -> Column:
    """The turn with its text fetched from ``texts`` where the record only names it."""
    place = F.substring(turn["text"], len(REF) + 1, 10).cast("int")
    return F.struct(turn["role"].alias("role"), F.when(turn["text"].startswith(REF), F.get(texts, place)).otherwise(turn["text"]).alias("text"))


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: dict | None = None,
                    texts_col: str | None = None) -> DataFrame:
    """Adds layout and turns (canonical) to records."""
    layouts = LAYOUTS if layouts is None else layouts
    mark = F.col("_fingerprint")
    layout, turns = F.lit("unknown"), F.lit(None).cast(TURNS)
    for name, spec in layouts.items():
        known = mark.isin(*[r for r in _literals(records, spec.paths())])
        layout = F.when(known, F.lit(name)).otherwise(layout)
        turns = F.when(known, spec.turns(F.col("_record")).cast(TURNS)).otherwise(turns)
    if texts_col:
        turns = F.transform(turns, lambda t: _outside(t, F.col(texts_col)))
    return (records.withColumn("_record", F.try_parse_json(F.col(record_col)))
            .withColumn("_fingerprint", fingerprint(field_paths(F.col("_record"))))
            .withColumns({"layout": layout, "turns": turns}).drop("_record", "_fingerprint"))


def _literals(df: DataFrame, paths: list[str]) -> list[str]:
    import hashlib

    return [hashlib.sha256(p.encode()).hexdigest() for p in paths]


# ------------------------------------------------------------------ template
def _pattern() -> str:
    signs = [ESC, *CONTROL]
    quoted = ["".join("\\" + c if not c.isalnum() else c for c in s) for s in signs]
    heads = [(q[:2], q[2:]) if q.startswith("\\") else (q[:1], q[1:]) for q in quoted]
    return "|".join(f"{h}(?={t})" if t else h for h, t in heads)


def escape(text: Column) -> Column:
    """An escape sign after the first character of every control string and escape sign."""
    return F.regexp_replace(text, f"({_pattern()})", "$1" + ESC + ESC)


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: the sign after '<', '[' or a sign goes."""
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def format_chat(turns: DataFrame, turns_col: str = "turns") -> DataFrame:
    """Adds ``segments`` (text, loss) and ``formatted``, their concatenation."""
    def segments(t):
        body = escape(t["text"])
        assistant = F.array(F.struct(body.alias("text"), F.lit(True).alias("loss")),
                            F.struct(F.lit("</s>").alias("text"), F.lit(False).alias("loss")))
        other = F.array(F.struct(F.concat(F.lit("[INST] "), F.url_encode(t["role"]), F.lit("\n"), body, F.lit(" [/INST]")).alias("text"),
                                 F.lit(False).alias("loss")))
        return F.when(t["role"] == "assistant", assistant).otherwise(other)
    out = turns.withColumn("segments", F.flatten(F.transform(F.col(turns_col), segments)))
    return out.withColumn("formatted", F.concat(F.lit("<s>"), F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``read_turns``, parsed from the formatted string, and ``loss_text`` from the mask."""
    body = F.substring("formatted", 4, 2147483647)
    marked = F.filter(F.split(body, r"(?<=</s>)|(?<=\[/INST\])"), lambda x: x != "")

    def turn(x):
        inner = F.substring(x, 8, 2147483647)
        cut = F.instr(inner, "\n")
        other = F.struct(F.url_decode(F.substr(inner, F.lit(1), cut - 1)).alias("role"),
                         unescape(F.substr(inner, cut + 1, F.length(inner) - cut - 8)).alias("text"))
        own = F.struct(F.lit("assistant").alias("role"), unescape(F.substr(x, F.lit(1), F.length(x) - 4)).alias("text"))
        return F.when(x.endswith("</s>"), own).otherwise(other)
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return formatted.withColumns({"read_turns": F.transform(marked, turn), "loss_text": F.array_join(masked, "")})


# ------------------------------------------------------------------ conversations table
def conversation_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                       role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turns in order; the partial aggregate gathers a conversation map-side first."""
    row = F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                   F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return (rows.groupBy(F.col(id_col).cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(row)).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x["role"], x["text"])).alias("turns")))


def to_records(turns: DataFrame) -> DataFrame:
    """conv_id, record, texts: each conversation as JSON in the layout its shape allows, long texts beside it."""
    size = F.aggregate("turns", F.lit(0).cast("long"), lambda n, x: n + F.char_length(x["text"]))
    apart = (size > INLINE) | F.exists("turns", lambda x: x["text"].startswith(REF))
    named = F.transform("turns", lambda x, k: F.struct(x["role"].alias("role"), F.concat(F.lit(REF), k.cast("string")).alias("text")))
    turns = turns.select("conv_id", F.when(apart, named).otherwise(F.col("turns")).alias("turns"),
                         F.when(apart, F.transform("turns", lambda x: x["text"])).alias("texts"))
    t = F.col("turns")
    roles = F.transform(t, lambda x: x["role"])
    messages = F.to_json(F.struct(F.transform(t, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))
    short = {v: k for k, v in ALIASES.items()}

    def from_name(r):
        out = r
        for name, alias in short.items():
            out = F.when(r == name, F.lit(alias)).otherwise(out)
        return out
    plain = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    from_value = F.to_json(F.struct(F.transform(t, lambda x: F.struct(from_name(x["role"]).alias("from"), x["text"].alias("value"))).alias("conversations")))

    def fields(*names):
        return F.to_json(F.struct(*[F.element_at(t, k + 1)["text"].alias(n) for k, n in enumerate(names)]))

    def are(*names):
        return roles == F.array(*[F.lit(n) for n in names])
    odd = F.pmod(F.col("conv_id"), F.lit(2)) == 1
    record = (F.when(are("user", "assistant") & odd, fields("instruction", "output"))
              .when(are("user", "assistant"), fields("prompt", "response"))
              .when(are("system", "user", "assistant"), fields("system", "prompt", "response"))
              .when(plain & odd, from_value).otherwise(messages))
    return turns.select("conv_id", record.alias("record"), "texts")


def digest(read: DataFrame) -> DataFrame:
    lines = F.flatten(F.transform("read_turns", lambda x: F.array(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return read.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "layout")


def format_conversations(rows: DataFrame) -> DataFrame:
    """Turn rows -> records -> canonical turns -> formatted text -> digests read back from it."""
    turns = canonical_turns(to_records(conversation_turns(rows)), texts_col="texts").drop("texts")
    known = F.when(F.col("layout") == "unknown", F.raise_error(F.concat(F.lit("no layout for conversation "), F.col("conv_id").cast("string")))).otherwise(F.col("turns"))
    return digest(read_back(format_chat(turns.withColumn("turns", known))))
