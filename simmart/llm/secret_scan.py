"""Secret scan with DataFrame functions only (operator 13).

Patterns find secrets that announce themselves. Beyond these, candidate strings (long runs of key characters) are scanned
by windows of fixed length, once for each character class. A window moves by one character: two counts of characters
change, and with them the sum of ``c * log2 c`` that gives the Shannon entropy. Windows with enough entropy for their
class join to spans, unless the candidate is on the allow-list or overlaps what a pattern has found.

All of it is one projection of the scan: nothing is shuffled, and a text without a match costs one search for each
pattern. Entropies are compared as whole millionths, so results don't depend on rounding.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names, patterns, group and least length of the three base kinds, in their order.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
# The last two in a form that finds long matches only: their characters are one run, so nothing else changes.
SEARCHED = (BASE[0][1], r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}")
KINDS = (*(b[0] for b in BASE), "entropy")

WINDOW = 24
CANDIDATE = r"[A-Za-z0-9+/_-]{24,}"
# Windows of one stretch of a candidate; stretches overlap by a window less one.
STRETCH = 2048
# Items of one fold of ``scan``.
FOLD = 256


@dataclass(frozen=True)
class CharClass:
    """Characters that a window must consist of, and its least entropy in bits."""

    name: str
    alphabet: str
    least: float


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    CharClass("hex", _DIGITS + "abcdefABCDEF", 3.2),
    CharClass("letters and digits", _DIGITS + _LOWER + _UPPER, 3.9),
    CharClass("base64", _DIGITS + _LOWER + _UPPER + "+/_-", 4.0),
)
# A candidate without a letter beside a digit is words or numbers joined by signs: names, paths, dates.
MIXED = r"[A-Za-z][0-9]|[0-9][A-Za-z]"
# Candidates that any of these finds are no secrets: UUIDs, runs of the alphabet, and fillers that say so.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i:abcdefgh|01234567|12345678)",
    r"(?i:example|placeholder|changeme|xxxxxx)",
)

_SPANS = "array<struct<start: bigint, kind: int, end: bigint>>"


# ---------------------------------------------------------------- arrays


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(items: Column, start: Column, advance: Callable, emit: Callable, out: str) -> Column:
    """``emit(state, item)`` of every item, where ``advance(state, item)`` is the state that the next item sees.

    Arrays grow by copies, so results are gathered in folds of ``FOLD`` items and the folds are flattened.
    """

    def run(own: Column) -> Column:
        def inner(acc, item):
            return F.struct(
                advance(acc["state"], item).alias("state"), F.array_append(acc["out"], emit(acc["state"], item)).alias("out")
            )

        def outer(acc, k):
            fresh = F.struct(acc["state"].alias("state"), F.array().cast(f"array<{out}>").alias("out"))
            return let(
                F.aggregate(F.slice(own, k * FOLD + 1, FOLD), fresh, inner),
                lambda a: F.struct(a["state"].alias("state"), F.array_append(acc["folds"], a["out"]).alias("folds")),
            )

        folds = F.sequence(F.lit(0), F.ceil(F.size(own) / FOLD).cast("int") - 1)
        zero = F.struct(start.alias("state"), F.array().cast(f"array<array<{out}>>").alias("folds"))
        done = F.flatten(F.aggregate(folds, zero, outer)["folds"])
        return F.when(F.size(own) == 0, F.array().cast(f"array<{out}>")).otherwise(done)

    return let(items, run)


def _long(value) -> Column:
    return F.lit(value).cast("long") if isinstance(value, int) else value.cast("long")


# ---------------------------------------------------------------- patterns


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``(start, value)``, in code points.

    The pieces between matches and the matches add up to the places.
    """

    def placed(zipped: Column) -> Column:
        ahead = scan(
            F.transform(zipped, lambda z: _long(F.length(z["gap"]) + F.coalesce(F.length(z["value"]), F.lit(0)))),
            _long(0),
            lambda total, n: total + n,
            lambda total, n: total,
            "bigint",
        )
        each = F.transform(
            F.arrays_zip(ahead.alias("ahead"), zipped.alias("z")),
            lambda a: F.struct((a["ahead"] + F.length(a["z"]["gap"])).alias("start"), a["z"]["value"].alias("value")),
        )
        return F.filter(each, lambda m: m["value"].isNotNull())

    between = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start: bigint, value: string>>")
    return F.when(text.rlike(pattern), let(F.arrays_zip(between.alias("gap"), values.alias("value")), placed)).otherwise(none)


def base_spans(text: Column, kind: int) -> Column:
    """Spans of one of the base patterns; matches that are too short take their place and go."""
    _, pattern, group, least = BASE[kind]
    kept = F.filter(
        matches(text, SEARCHED[kind]),
        lambda m: F.length(F.regexp_extract(m["value"], pattern, group) if group else m["value"]) >= least,
    )
    return F.transform(kept, lambda m: _span(m["start"], kind, m["start"] + F.length(m["value"])))


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(_long(start).alias("start"), F.lit(kind).alias("kind"), _long(end).alias("end"))


# ---------------------------------------------------------------- entropy

# Counts of a window are packed in longs: so many bits each, so many in one. A window is shorter than 2^bits.
_BITS, _EACH = 5, 12


def weights(window: int) -> list[int]:
    """``c * log2 c`` in millionths, for counts from 0."""
    return [0, *(round(c * math.log2(c) * 1e6) for c in range(1, window + 1))]


def most(window: int, least: float) -> int:
    """Entropy is ``log2 w - sum(c log2 c) / w``: the largest sum, in millionths, with at least this entropy."""
    return math.floor((math.log2(window) - least) * window * 1e6)


def hot_windows(value: Column, kind: CharClass, window: int = WINDOW) -> Column:
    """Joined windows of a string with enough entropy in a class, as ``(start, end)`` from 0.

    One fold over the characters. Its state holds the packed counts of the window, the sum of ``c log2 c``, how many of
    the last characters are of the class, the spans so far and the last one.
    """
    table = F.array(*map(_long, weights(window)))
    empty = F.array(*[_long(0)] * -(-len(kind.alphabet) // _EACH))
    limit = most(window, kind.least)

    def moved(counts: Column, total: Column, code: Column, by: int) -> Column:
        """Counts and sum after ``by`` more characters of one code."""
        word, bits = F.floor(code / _EACH).cast("int"), (code % _EACH) * _BITS
        shifted = F.call_function("shiftright", F.element_at(counts, word + 1), bits)
        one = F.call_function("shiftleft", _long(1), bits) * by
        return let(
            shifted.bitwiseAND(_long((1 << _BITS) - 1)).cast("int"),
            lambda n: F.struct(
                F.transform(counts, lambda w, k: F.when(k == word, w + one).otherwise(w)).alias("counts"),
                (total + F.element_at(table, n + 1 + by) - F.element_at(table, n + 1)).alias("total"),
            ),
        )

    def state(counts, total, filled, spans, first, last) -> Column:
        return F.struct(
            counts.alias("counts"), total.alias("total"), filled.alias("filled"), spans.alias("spans"), first.alias("first"), last.alias("last")
        )

    def run(codes: Column) -> Column:
        def entered(acc: Column, now: Column, i: Column) -> Column:
            filled, start = F.least(acc["filled"] + 1, F.lit(window)), _long(i + 1 - window)
            hot = (filled == window) & (now["total"] <= limit)
            new = hot & (acc["last"] < start)
            closed = F.array_append(acc["spans"], F.struct(acc["first"].alias("start"), acc["last"].alias("end")))
            return state(
                now["counts"],
                now["total"],
                filled,
                F.when(new & (acc["last"] >= 0), closed).otherwise(acc["spans"]),
                F.when(new, start).otherwise(acc["first"]),
                F.when(hot, _long(i + 1)).otherwise(acc["last"]),
            )

        def step(acc: Column, i: Column) -> Column:
            code = F.element_at(codes, i + 1)
            left = F.when(
                acc["filled"] == window, moved(acc["counts"], acc["total"], F.element_at(codes, i + 1 - window), -1)
            ).otherwise(F.struct(acc["counts"].alias("counts"), acc["total"].alias("total")))
            inside = let(
                left, lambda a: let(moved(a["counts"], a["total"], code, 1), lambda b: entered(acc, b, i))
            )
            outside = state(empty, _long(0), F.lit(0), acc["spans"], acc["first"], acc["last"])
            return F.when(code < 0, outside).otherwise(inside)

        start = state(empty, _long(0), F.lit(0), F.array().cast("array<struct<start: bigint, end: bigint>>"), _long(-1), _long(-1))
        return let(
            F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step),
            lambda a: F.when(a["last"] < 0, a["spans"]).otherwise(
                F.array_append(a["spans"], F.struct(a["first"].alias("start"), a["last"].alias("end")))
            ),
        )

    # numbers of the characters in the class from 0, -1 outside
    return let(F.transform(F.split(value, ""), lambda c: F.instr(F.lit(kind.alphabet), c) - 1), run)


def entropy_spans(text: Column, classes: tuple[CharClass, ...] = CLASSES) -> Column:
    """Spans of candidates' hot windows, as found in each class and stretch; they may overlap."""
    allowed = lambda v: ~v.rlike(MIXED) | v.rlike("|".join(ALLOWED))

    def of_candidate(m: Column) -> Column:
        stretches = F.sequence(F.lit(0), F.floor((F.length(m["value"]) - WINDOW) / STRETCH).cast("int"))

        def of_stretch(k: Column) -> Column:
            at = k * STRETCH
            own = F.substring(m["value"], at + 1, F.lit(STRETCH + WINDOW - 1))
            hot = F.concat(*(hot_windows(own, c) for c in classes))
            return F.transform(hot, lambda w: _span(m["start"] + at + w["start"], len(BASE), m["start"] + at + w["end"]))

        return F.flatten(F.transform(stretches, of_stretch))

    candidates = F.filter(matches(text, CANDIDATE), lambda m: ~allowed(m["value"]))
    return F.flatten(F.transform(candidates, of_candidate))


def join_spans(spans: Column) -> Column:
    """Spans of one kind that overlap or touch become one."""

    def joined(ordered: Column) -> Column:
        before = scan(ordered, _long(-1), lambda far, s: F.greatest(far, s["end"]), lambda far, s: far, "bigint")
        firsts = F.filter(
            F.arrays_zip(before.alias("before"), ordered.alias("s")), lambda z: z["s"]["start"] > z["before"]
        )
        furthest = F.array_max(F.transform(ordered, lambda s: s["end"]))
        return let(
            firsts,
            lambda f: F.transform(
                f,
                lambda z, k: F.struct(
                    z["s"]["start"].alias("start"), z["s"]["kind"].alias("kind"), F.coalesce(F.get(f, k + 1)["before"], furthest).alias("end")
                ),
            ),
        )

    return let(F.sort_array(spans), joined)


def apart_from(spans: Column, base: Column) -> Column:
    """Spans that overlap none of the base spans: none before reaches into them, none after starts in them."""

    def kept(ordered: Column) -> Column:
        known = lambda s: s["kind"] < len(BASE)
        before = scan(
            ordered, _long(0), lambda far, s: F.when(known(s), F.greatest(far, s["end"])).otherwise(far), lambda far, s: far, "bigint"
        )
        after = F.reverse(
            scan(
                F.reverse(ordered),
                _long(2**62),
                lambda near, s: F.when(known(s), F.least(near, s["start"])).otherwise(near),
                lambda near, s: near,
                "bigint",
            )
        )
        free = F.filter(
            F.arrays_zip(ordered.alias("s"), before.alias("before"), after.alias("after")),
            lambda z: ~known(z["s"]) & (z["before"] <= z["s"]["start"]) & (z["after"] >= z["s"]["end"]),
        )
        return F.transform(free, lambda z: z["s"])

    return F.when(F.size(spans) == 0, spans).otherwise(let(F.sort_array(F.concat(spans, base)), kept))


# ---------------------------------------------------------------- operator


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, base, spans)`` of every row: arrays of ``(start, kind, end)`` in code points, ends exclusive.

    ``base`` holds what the patterns of ``BASE`` find, ``spans`` these and the spans of high entropy, both by start,
    then kind (a number in ``KINDS``). A null text is empty; further columns don't matter; rows of one id stay apart.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    found = own.select(
        "id",
        F.sort_array(F.concat(*(base_spans(F.col("text"), k) for k in range(len(BASE))))).alias("base"),
        join_spans(entropy_spans(F.col("text"))).alias("hot"),
    )
    return found.select("id", "base", F.sort_array(F.concat("base", apart_from(F.col("hot"), F.col("base")))).alias("spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    kind = F.array(*map(F.lit, KINDS))
    said = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(said, ",")
