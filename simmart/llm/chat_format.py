"""Chat formatting with DataFrame functions only (operator 6).

The nested field paths of a frame or of a JSON record are hashed to a fingerprint, which selects a declarative mapping
to canonical turns ``(conv_id, turn, role, text)``. Turns are rendered with one template, whose markers cannot occur in
a text: control strings inside texts are broken up by a backslash, which reading back removes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, SEP, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
# The control strings of common templates, as what follows their first character.
CONTROL = r"<(\||/?s>|</?SYS>>)|\[(/?INST\])"


@dataclass(frozen=True)
class Mapping:
    """One layout of records: its field paths, and where roles and texts stand.

    ``layout`` is the tree of field names in alphabetical order. Either ``turns`` lists ``(role, fields)`` of a record,
    where the fields that have text are joined by an empty line, or ``each`` names the list of messages with ``role``
    and ``text`` as its fields.
    """

    name: str
    layout: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)


MAPPINGS = (
    Mapping("turn rows", "OBJECT<conv_id, role, text, turn>", role="role", text="text"),
    Mapping("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", each="messages", role="role", text="content"),
    Mapping(
        "from and value",
        "OBJECT<conversations: ARRAY<OBJECT<from, value>>>",
        each="conversations",
        role="from",
        text="value",
        roles={"human": "user", "gpt": "assistant"},
    ),
    Mapping(
        "instruction with input",
        "OBJECT<input, instruction, output>",
        turns=(("user", ("instruction", "input")), ("assistant", ("output",))),
    ),
    Mapping("instruction", "OBJECT<instruction, output>", turns=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("prompt", "OBJECT<prompt, response>", turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("completion", "OBJECT<completion, prompt>", turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping(
        "system prompt",
        "OBJECT<prompt, response, system>",
        turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
    ),
)

_TURNS = "array<struct<role: string, text: string>>"


# ---------------------------------------------------------------- fingerprints and mappings


def _layout(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return "OBJECT<" + ", ".join(_field(f.name, f.dataType) for f in sorted(kind, key=lambda f: f.name)) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_layout(kind.elementType)}>"
    return ""


def _field(name: str, kind: T.DataType) -> str:
    inner = _layout(kind)
    return f"{name}: {inner}" if inner else name


def fingerprint(layout: Column) -> Column:
    """The hash of the tree of field names of a record; null without one."""
    return F.sha2(layout, 256)


def print_of(layout: str) -> str:
    """The same of a known layout."""
    return hashlib.sha256(layout.encode()).hexdigest()


BY_PRINT = {print_of(m.layout): m for m in MAPPINGS}


def json_layout(record: Column) -> Column:
    """The tree of field names of a JSON text, or null when it is no JSON."""
    typed = F.schema_of_variant(F.try_parse_json(record))
    return F.regexp_replace(typed, r": [A-Z]+(\([0-9]+,[0-9]+\))?(?=[,>])", "")


def frame_mapping(df: DataFrame) -> Mapping | None:
    """The mapping of the fingerprint of a frame's fields; columns beyond a mapping's don't matter. The one with most
    fields wins."""
    for names in sorted({frozenset(_top_level(m.layout)) for m in MAPPINGS}, key=lambda n: (-len(n), sorted(n))):
        own = T.StructType([f for f in df.schema if f.name in names])
        if (found := BY_PRINT.get(print_of(_layout(own)))) is not None:
            return found
    return None


def _top_level(layout: str) -> set[str]:
    names, depth, name = set(), 0, ""
    for c in layout.removeprefix("OBJECT<")[:-1] + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            names.add(name.split(":")[0].strip())
            name = ""
        else:
            name += c
    return names


def _mapped_role(role: Column, mapping: Mapping) -> Column:
    for theirs, ours in mapping.roles.items():
        role = F.when(role == theirs, F.lit(ours)).otherwise(role)
    return role


def _turns(mapping: Mapping, get) -> Column:
    """Turns of one record as an array; ``get(path, type)`` reads a field of the record."""
    if mapping.each:
        items = get(mapping.each, f"array<struct<`{mapping.role}`: string, `{mapping.text}`: string>>")
        return F.transform(
            items,
            lambda m: F.struct(
                _mapped_role(m[mapping.role], mapping).alias("role"), m[mapping.text].alias("text")
            ),
        )
    every = F.array(
        *(
            F.struct(
                F.lit(role).alias("role"),
                F.concat_ws("\n\n", *(F.nullif(get(f, "string"), F.lit("")) for f in fields)).alias("text"),
            )
            for role, fields in mapping.turns
        )
    )
    return F.filter(every, lambda t: (t["role"] != "system") | (t["text"] != ""))


def _exploded(records: DataFrame, id_col: str, turns: Column) -> DataFrame:
    return records.select(F.col(id_col).alias("conv_id"), F.posexplode(turns).alias("turn", "item")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "item.role", "item.text"
    )


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``(conv_id, turn, role, text)`` of a frame whose columns have one of the known layouts."""
    mapping = frame_mapping(df)
    if mapping is None:
        raise ValueError(f"no mapping for {_layout(df.schema)}")
    if mapping.name == "turn rows":
        return df.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return _exploded(df, id_col, _turns(mapping, lambda path, kind: F.col(path).cast(kind)))


def canonical_json(records: DataFrame, id_col: str, json_col: str) -> tuple[DataFrame, DataFrame]:
    """Turns of JSON records of mixed layouts, and ``(id, layout, fingerprint)`` of the records without a mapping."""
    variant = F.try_parse_json(F.col(json_col))
    known = records.withColumn("_layout", json_layout(F.col(json_col))).withColumn("_print", fingerprint(F.col("_layout")))
    turns = F.lit(None).cast(_TURNS)
    for mapping in MAPPINGS[1:]:
        own = _turns(mapping, lambda path, kind: F.try_variant_get(variant, f"$.{path}", kind)).cast(_TURNS)
        turns = F.when(F.col("_print") == print_of(mapping.layout), own).otherwise(turns)
    mapped = known.withColumn("_turns", turns)
    rejects = mapped.filter(F.col("_turns").isNull()).select(
        F.col(id_col), F.col("_layout").alias("layout"), F.col("_print").alias("fingerprint")
    )
    return _exploded(mapped, id_col, F.col("_turns")), rejects


# ---------------------------------------------------------------- template


def escape(text: Column) -> Column:
    """Doubles backslashes and puts one behind the first character of every control string."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    angled = F.regexp_replace(doubled, r"<(\||/?s>|</?SYS>>)", r"<\\$1")
    return F.regexp_replace(angled, r"\[(/?INST\])", r"[\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``(conv_id, n_turns, formatted, loss_spans)`` of canonical turns.

    ``loss_spans`` are ranges of code points of ``formatted`` that hold the texts of ``loss_role``, in order. Turns are
    ordered by turn, then role and text (nulls first); repeated rows stay. A null role or text is empty, rows without
    conv_id form one conversation. A conversation is one row, so one executor holds it; its lengths are summed by a
    window before that, not by growing arrays.
    """
    rendered = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SEP)).alias("head"),
        escape(F.col("text")).alias("body"),
    ).withColumn("size", F.length("head") + F.length("body") + len(CLOSE))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rendered.select(
        "conv_id",
        "role",
        F.row_number().over(in_order).alias("place"),
        (F.sum(F.col("size").cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("start"),
        "head",
        "body",
    )
    piece = F.struct(
        "place",
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        (F.col("role") == loss_role).alias("counts"),
        (F.col("start") + F.length("head")).alias("start"),
        (F.col("start") + F.length("head") + F.length("body")).alias("end"),
    )
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return grouped.select(
        "conv_id",
        F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        F.transform(
            F.filter("pieces", lambda p: p["counts"]),
            lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")),
        ).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of roles and texts."""
    marked = F.split(formatted, r"<\|im_start\|>")
    return F.transform(
        F.slice(marked, F.lit(2), F.size(marked)),
        lambda t: F.struct(
            unescape(F.substring_index(t, SEP, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(t, SEP, -1), CLOSE, 1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask as an array.

    In UTF-32 every code point has four bytes, so a span is a range of bytes and is read without a look at what
    precedes it. Each piece gets a byte order mark of its own, which decoding takes away again.
    """
    mark = F.lit(b"\x00\x00\xfe\xff")

    def read(raw: Column) -> Column:
        return F.transform(
            spans,
            lambda s: unescape(
                F.decode(
                    F.concat(mark, F.substring(raw, (4 * s["start"] + 1).cast("int"), (4 * (s["end"] - s["start"])).cast("int"))),
                    "UTF-32",
                )
            ),
        )

    return F.get(F.transform(F.array(F.encode(formatted, "UTF-32")), read), F.lit(0))
