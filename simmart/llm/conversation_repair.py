"""Repair of conversation structure by weighted CYK parsing (operator 11).

A repaired conversation reads ``(s?(ua)+)?`` by the first letters of its roles. The repair grammar is in Chomsky normal
form: its nonterminals are pairs ``[p, q]`` of reader states ("rows that lead from p to q"), its binary rules are
``[p, q] -> [p, r] [r, q]`` and its terminals are rows under one edit: Keep (K), Rerole to user or assistant (R), Delete
(D). Insert (I) has no row; cells are closed under it. A chart cell holds, for each nonterminal, the least
``(cost, audit)`` of its span, where the audit is the string of edit letters. Cells are combined bottom-up by span length.

The language is regular, so every derivation of ``[p, q]`` can be split at every row; one split for each span finds the
minimum, and a conversation of n rows needs the n - 1 spans of lengths 1, 2, 4, ... instead of n * n. The same rule
combines spans of different tasks. Two audits of one cell with equal cost are never prefixes of one another (letters
that consume rows have the rows' costs, and further inserts cost more), so the least of a whole is made of least parts.

Rows of a conversation stand by turn (nulls first), role and text, all by bytes. They are dealt out by ranges of that order,
so that a conversation of any length is spread over tasks, and repeated rows travel as one with a count. A task streams
over its rows in spans of at most ``span_rows`` rows, closed at ``SPAN_BYTES``. Only the cells of spans of conversations that
may have several spans meet by conversation: letters, no texts.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simmart.session import stage

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
# Faults of a row; a row has the first that holds.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

# States of the reader, and where the first letter of a role leads from each.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}

SPAN_ROWS, SPAN_BYTES = 512, 1 << 20
# Spans of one Arrow batch.
BATCH_SPANS, BATCH_BYTES = 2000, 8 << 20

# {p: [(q, cost, audit), ...]}
Cell = dict[int, list[tuple[int, int, str]]]


# ---------------------------------------------------------------- grammar and chart


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans: ``[p, q] -> [p, r] [r, q]``, least cost, then least audit."""
    out = {}
    for p, firsts in left.items():
        best: dict[int, tuple[int, str]] = {}
        for r, cost, audit in firsts:
            for q, more, rest in right.get(r, ()):
                old = best.get(q)
                if old is None or cost + more < old[0]:
                    best[q] = (cost + more, audit + rest)
                elif cost + more == old[0] and audit + rest < old[1]:
                    best[q] = (old[0], audit + rest)
        if best:
            out[p] = [(q, *v) for q, v in best.items()]
    return out


def _insert_closure() -> Cell:
    """The cell of no row: any number of inserted turns."""
    step: Cell = {p: [(p, 0, "")] for p in range(4)}
    for (p, letter), q in STEPS.items():
        if letter in ROLES:
            step[p].append((q, COSTS[INSERT], INSERT))
    closed = step
    while (more := combine(closed, step)) != closed:
        closed = more
    return closed


INSERTS = _insert_closure()
_leaves: dict[tuple[str, int], Cell] = {}


def leaf(initial: str, fault: int) -> Cell:
    """The cell of one row, closed under inserts before and after it."""
    if (initial, fault) not in _leaves:
        edits: Cell = {p: [(p, COSTS[DELETE], DELETE)] for p in range(4)}
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED_COST if fault == TRUNCATED else 0
            for (p, letter), q in STEPS.items():
                if letter == initial:
                    edits[p].append((q, COSTS[KEEP] + extra, KEEP))
                elif letter in ROLES:
                    edits[p].append((q, COSTS[REROLE] + extra, REROLE))
        _leaves[initial, fault] = combine(combine(INSERTS, edits), INSERTS)
    return _leaves[initial, fault]


def parse(cells: list[Cell]) -> Cell:
    """The cell of a row of adjacent spans, by spans of double length each time."""
    while len(cells) > 1:
        pairs = [combine(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0] if cells else INSERTS


def best_whole(cell: Cell) -> tuple[int, str]:
    """Least cost and audit that read a whole conversation."""
    return min((cost, audit) for q, cost, audit in cell[START] if q in ENDS)


def initial_of(role: str) -> str:
    """First letter of a role when the grammar has it, else no letter."""
    return role[:1] if role[:1] in ("s", "u", "a") else ""


def replay(rows: list[dict], audit: str, state: int) -> tuple[list[dict], int]:
    """The turns that an audit makes of rows, and the state after them. Reroled and inserted turns take the role that follows."""
    turns, at = [], 0
    for letter in audit:
        row = None if letter == INSERT else rows[at]
        at += row is not None
        if letter == DELETE:
            continue
        initial = initial_of(row["role"]) if letter == KEEP else "a" if state == USER else "u"
        role = row["role"] if letter == KEEP else ROLES[initial]
        turns.append({"role": role, "text": row["text"] if row else "", "edit": letter})
        state = STEPS[state, initial]
    return turns, state


# ---------------------------------------------------------------- spans of a task

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))
_CELL = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _span_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("conv_id", id_type), ("part", pa.int32()), ("span", pa.int32()), ("whole", pa.bool_()), ("rows", _ROWS), ("cell", _CELL)]
        + [("fixed", _TURNS), ("cost", pa.int64()), ("audit", pa.string())]
        + [(c, pa.int64()) for c in (*_COUNTS, "low", "high", "first_turn", "last_turn")]
        + [("first", pa.string()), ("last", pa.string())]
    )


_SPAN_DDL = (
    "part int, span int, whole boolean, rows array<struct<role: string, text: string>>, "
    "cell array<struct<p: int, q: int, cost: bigint, audit: string>>, "
    "fixed array<struct<role: string, text: string, edit: string>>, cost bigint, audit string, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
    "low bigint, high bigint, first_turn bigint, last_turn bigint, first string, last string"
)

_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class _Span:
    """Rows of one conversation that stand together in a task."""

    def __init__(self, conv_id, number: int):
        self.conv_id, self.number = conv_id, number
        self.rows, self.cells, self.bytes = [], [], 0
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn, role: str, text: str, size: int, fault: int) -> None:
        initial = initial_of(role)
        if fault:
            self.counts[("", *_COUNTS)[fault]] += 1
        if self.last is None:
            self.first = initial
        elif (self.last, initial) not in _LEGAL:
            self.counts["illegal"] += 1
        self.last = initial
        if turn is not None:
            if turn != self.last_turn:
                self.counts["turns"] += 1
            if self.low is None:
                self.low = self.first_turn = turn
            self.high = self.last_turn = turn
        self.cells.append(leaf(initial, fault))
        self.rows.append({"role": role, "text": text})
        self.bytes += size

    def record(self, part: int, whole: bool) -> dict:
        cell = parse(self.cells)
        own = {"conv_id": self.conv_id, "part": part, "span": self.number, "whole": whole, **self.counts}
        own |= {c: getattr(self, c) for c in ("low", "high", "first_turn", "last_turn", "first", "last")}
        if whole:
            cost, audit = best_whole(cell)
            return own | {"cost": cost, "audit": audit, "fixed": replay(self.rows, audit, START)[0]}
        entries = [{"p": p, "q": q, "cost": c, "audit": a} for p, ends in cell.items() for q, c, a in ends]
        return own | {"cell": entries, "rows": self.rows}


def _task_spans(span_rows: int):
    return lambda batches: _spans_of(batches, span_rows)


def _spans_of(batches, span_rows: int):
    """Spans of the sorted rows of a task. A conversation that lies inside the task, in one span, is repaired at once."""
    part, schema, out, size, at = TaskContext.get().partitionId(), None, [], 0, None
    number, opening, goes_on = 0, True, False
    for batch in batches:
        schema = schema or _span_schema(batch.schema.field("conv_id").type)
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "size", "fault", "copies")]
        for conv_id, turn, role, text, length, fault, copies in zip(*columns):
            if at is None or conv_id != at.conv_id:
                if at is not None:
                    out.append(at.record(part, whole=not opening and not goes_on))
                    size, opening = size + at.bytes, False
                number, goes_on = number + 1, False
                at = _Span(conv_id, number)
            for copy in range(copies):
                if len(at.rows) >= span_rows or at.bytes >= SPAN_BYTES:
                    out.append(at.record(part, whole=False))
                    size, number, goes_on = size + at.bytes, number + 1, True
                    at = _Span(conv_id, number)
                # a repeated row is a duplicate of the first one, unless it is blank
                at.add(turn, role, text, length, DUPLICATE if copy and fault != BLANK else fault)
            if len(out) >= BATCH_SPANS or size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
    if at is not None:
        out.append(at.record(part, whole=False))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


# ---------------------------------------------------------------- conversations of several spans


def _total_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("conv_id", id_type), ("part", pa.int32()), ("span", pa.int32()), ("place", pa.int64()), ("state", pa.int32())]
        + [("span_audit", pa.string()), ("leads", pa.bool_()), ("cost", pa.int64()), ("audit", pa.string())]
        + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")]
    )


_TOTAL_DDL = (
    "part int, span int, place bigint, state int, span_audit string, leads boolean, cost bigint, audit string, "
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)
_MOST = 2**63 - 1


def _join_spans(table: pa.Table) -> pa.Table:
    """The spans of one conversation: its totals, and what its best audit does in each span."""
    schema = _total_schema(table.schema.field("conv_id").type)
    spans = sorted(table.to_pylist(), key=lambda s: (s["part"], s["span"]))
    cells = []
    for span in spans:
        cell: Cell = {}
        for e in span["cell"]:
            cell.setdefault(e["p"], []).append((e["q"], e["cost"], e["audit"]))
        cells.append(cell)
    cost, audit = best_whole(parse(cells))
    totals = {c: sum(s[c] for s in spans) for c in ("blank", "duplicate", "truncated", "illegal")}
    turns, last_turn, last = 0, None, None
    for span in spans:
        turns += span["turns"] - (span["first_turn"] is not None and span["first_turn"] == last_turn)
        last_turn = last_turn if span["last_turn"] is None else span["last_turn"]
        if span["last"] is not None:
            totals["illegal"] += last is not None and (last, span["first"]) not in _LEGAL
            last = span["last"]
    lows, highs = ([s[c] for s in spans if s[c] is not None] for c in ("low", "high"))
    totals["gaps"] = min(_MOST, max(highs) - min(lows) + 1 - turns) if lows else 0
    out, at, state, place = [], 0, START, 0
    for i, span in enumerate(spans):
        left = span["n"]
        end = at
        while end < len(audit) and (left or i == len(spans) - 1):
            left -= audit[end] != INSERT
            end += 1
        piece = audit[at:end]
        row = {"conv_id": span["conv_id"], "part": span["part"], "span": span["span"], "place": place, "state": state}
        out.append(row | {"span_audit": piece, "leads": i == 0, "cost": cost, "audit": audit if i == 0 else None} | totals)
        initials = span["initials"]
        row_at = 0
        for letter in piece:
            if letter != DELETE:
                initial = initials[row_at] if letter == KEEP else "a" if state == USER else "u"
                state, place = STEPS[state, initial], place + 1
            row_at += letter != INSERT
        at = end
    return pa.Table.from_pylist(out, schema)


def _replay_batches(batches):
    schema = None
    for batch in batches:
        schema = schema or pa.schema(
            [batch.schema.field("conv_id"), ("part", pa.int32()), ("span", pa.int32()), ("place", pa.int64()), ("fixed", _TURNS)]
        )
        rows = batch.to_pylist()
        out = [
            {c: r[c] for c in ("conv_id", "part", "span", "place")} | {"fixed": replay(r["rows"], r["span_audit"], r["state"])[0]}
            for r in rows
        ]
        yield pa.RecordBatch.from_pylist(out, schema)


# ---------------------------------------------------------------- operator


class Repaired(NamedTuple):
    """``conversations``: one row for each; ``spans``: their turns, ``(conv_id, whole, part, span, place, fixed)``."""

    conversations: DataFrame
    spans: DataFrame

    @property
    def turns(self) -> DataFrame:
        """``(conv_id, place, role, text, edit)``; places count from 0."""
        each = self.spans.select("conv_id", "place", F.posexplode("fixed").alias("at", "turn"))
        return each.select("conv_id", (F.col("place") + F.col("at")).alias("place"), "turn.role", "turn.text", "turn.edit")


def damage(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)`` of rows damaged by a hash of conversation and turn; nulls are one space.

    Of 20 remainders 0 drops the row (0 copies), 1 empties the text, 2 removes its ``[.!?]``, 3 repeats the row and
    4 makes the role ``user``.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )


def _faults(turns: DataFrame) -> DataFrame:
    """Distinct rows with their copies and the fault of the first copy."""
    # lengths before the parts: no two rows share a key
    owner = F.when(F.col("conv_id").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string")))
    said = F.concat(F.length(owner), F.lit(":"), owner, F.lit(":"), F.length("role"), F.lit(":"), "role", "text")
    keyed = turns.withColumn("key", F.unhex(F.sha2(said, 256)))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    order = F.struct(F.col("turn").isNotNull(), "turn")
    repeated = (
        keyed.filter((F.col("copies") > 0) & ~blank)
        .groupBy("key")
        .agg(F.min(order).alias("earliest"), F.max(order).alias("latest"))
        .filter(~F.col("earliest").eqNullSafe(F.col("latest")))
        .select("key", "earliest")
    )
    fault = (
        F.when(blank, F.lit(BLANK))
        .when(F.col("earliest").isNotNull() & ~order.eqNullSafe(F.col("earliest")), F.lit(DUPLICATE))
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), F.lit(TRUNCATED))
        .otherwise(F.lit(SOUND))
    )
    rows = keyed.groupBy("key", "conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    return rows.join(repeated, "key", "left").select(
        "conv_id", "turn", "role", "text", F.octet_length("text").alias("size"), fault.alias("fault"), "copies"
    )


def repair(turns: DataFrame, span_rows: int = SPAN_ROWS) -> Repaired:
    """Least-cost repair of conversations given as ``(conv_id, turn, role, text)`` and, if there, ``copies`` of a row.

    Further columns don't matter. Null roles and texts are empty, rows without conv_id are one conversation, rows
    without turn come first. A row with 0 copies only names its conversation; one without other rows is returned with
    zeros and an empty audit. ``conversations`` has ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``.
    A role whose first letter is not s, u or a cannot be kept and is never legal. An audit is one string, one letter an edit.
    """
    copies = F.coalesce(F.col("copies").cast("long"), F.lit(1)) if "copies" in turns.columns else F.lit(1).cast("long")
    own = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
        copies.alias("copies"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role")]
    # long texts would make the boundaries of ranges large: the ranges look at beginnings, the order at whole texts
    ranged = _faults(own).repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    id_type = turns.schema["conv_id"].dataType
    named = T.StructType([T.StructField("conv_id", id_type)])
    spans = stage(ranged.mapInArrow(_task_spans(span_rows), _with(named, _SPAN_DDL)), "spans")

    cut = spans.filter(~F.col("whole"))
    cells = cut.select(
        "conv_id", "part", "span", "cell", *_COUNTS, "low", "high", "first_turn", "last_turn", "first", "last",
        F.size("rows").cast("long").alias("n"),
        F.transform("rows", lambda r: _initial(r["role"])).alias("initials"),
    )
    totals = stage(cells.groupBy("conv_id").applyInArrow(_join_spans, _with(named, _TOTAL_DDL)), "span_totals")

    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))
    inside = spans.filter("whole")
    counts = ("blank", "duplicate", "truncated", "illegal", "cost", "audit")
    conversations = inside.select("conv_id", gaps.alias("gaps"), *counts).unionByName(
        totals.filter("leads").select("conv_id", "gaps", *counts)
    )
    # part and span name a span by themselves
    decided = cut.select("part", "span", "rows").join(totals, ["part", "span"])
    replayed = decided.select("conv_id", "part", "span", "place", "rows", "span_audit", "state").mapInArrow(
        _replay_batches, _with(named, "part int, span int, place bigint, fixed array<struct<role: string, text: string, edit: string>>")
    )
    first = inside.select("conv_id", "whole", "part", "span", F.lit(0).cast("long").alias("place"), "fixed")
    return Repaired(conversations, first.unionByName(replayed.withColumn("whole", F.lit(False))))


def _hash_batches(batches):
    """SHA-256 of the texts of each conversation, whose spans follow one another; a span is held at a time."""
    schema, running, out, now = None, None, [], None
    for batch in batches:
        schema = schema or pa.schema([batch.schema.field("conv_id"), ("sha256", pa.string())])
        for conv_id, lines in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "lines"))):
            if running is None or conv_id != now:
                if running is not None:
                    out.append({"conv_id": now, "sha256": running.hexdigest()})
                running, now, empty = hashlib.sha256(), conv_id, True
            for line in lines:
                running.update(("" if empty else "\n").encode() + line.encode())
                empty = False
        yield pa.RecordBatch.from_pylist(out, schema)
        out = []
    if running is not None:
        yield pa.RecordBatch.from_pylist([{"conv_id": now, "sha256": running.hexdigest()}], schema)


def text_digests(spans: DataFrame) -> DataFrame:
    """``(conv_id, sha256)`` of the repaired ``role:text`` of each conversation, joined by line breaks."""
    lines = F.transform("fixed", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    inside = spans.filter("whole").select("conv_id", F.sha2(F.array_join(lines, "\n"), 256).alias("sha256"))
    cut = spans.filter(~F.col("whole")).select("conv_id", "part", "span", lines.alias("lines"))
    in_order = cut.repartition("conv_id").sortWithinPartitions("conv_id", "part", "span")
    schema = _with(T.StructType([spans.schema["conv_id"]]), "sha256 string")
    return inside.unionByName(in_order.mapInArrow(_hash_batches, schema))


def _initial(role: Column) -> Column:
    letter = F.substring(role, 1, 1)
    return F.when(letter.isin("s", "u", "a"), letter).otherwise(F.lit(""))


def _with(named: T.StructType, ddl: str) -> T.StructType:
    return T.StructType(named.fields + T.StructType.fromDDL(ddl).fields)
