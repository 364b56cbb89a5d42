"""Test items inside documents, with a few edits (operator 4).

An item that occurs with at most k edits contains at least one of its k + 1 pieces unchanged. An automaton over all
pieces finds exact hits in one pass through a text; around a hit Myers' bit-parallel distance decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Edits allowed: one for each so many characters of the item.
CHARS_PER_EDIT = 20
# No piece gets shorter than this; short items then have fewer edits.
MIN_PIECE = 8
# Items of one automaton. More items make more passes over the texts, not a larger table in a task.
ITEM_BYTES = 2 << 20

MATCHES = "array<struct<item: long, distance: int, start: int, end: int>>"


def normal(text: str) -> str:
    """Lower case, runs of white space as one blank, none at the ends."""
    return " ".join(text.lower().split())


def edits(item: str, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    return max(0, min(len(item) // chars_per_edit, len(item) // MIN_PIECE - 1))


def item_pieces(item: str, k: int) -> list[tuple[int, str]]:
    """The item cut into k + 1 pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, k: int) -> tuple[int, int] | None:
    """Smallest edit distance between the pattern and any part of the text, at most k, and where that part ends.

    One addition and a few logical operations on numbers of ``len(pattern)`` bits for each character of the text.
    """
    m = len(pattern)
    ones, top = (1 << m) - 1, 1 << (m - 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    up, down, score, best = ones, 0, m, None
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        x = eq | down
        d0 = ((((eq & up) + up) ^ up) | x) & ones
        hp = (down | ~(d0 | up)) & ones
        hn = up & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 & ones
        up = ((hn << 1 & ones) | ~(d0 | hp)) & ones
        down = hp & d0
        if score <= k and (best is None or score < best[0]):
            best = score, j + 1
    return best


def find_item(item: str, text: str, k: int) -> tuple[int, int, int] | None:
    """``(distance, start, end)`` of the best place of the item in a text."""
    hit = myers(item, text, k)
    if hit is None:
        return None
    distance, end = hit
    # Backwards from that end the shortest part with the same distance gives the start.
    back = myers(item[::-1], text[max(0, end - len(item) - k) : end][::-1], distance)
    return distance, end - back[1], end


class Searcher:
    """All pieces of one block of items."""

    def __init__(self, items: list[tuple[int, str]], chars_per_edit: int):
        self.items = [(i, n, edits(n, chars_per_edit)) for i, t in items if (n := normal(t))]
        found = defaultdict(list)
        for at, (_, text, k) in enumerate(self.items):
            for offset, piece in item_pieces(text, k):
                found[piece].append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Places of the text where an item may stand, overlapping ones joined."""
        places = defaultdict(list)
        for end, (size, where) in self.automaton.iter(text):
            for at, offset in where:
                _, item, k = self.items[at]
                start = end + 1 - size - offset
                low, high = max(0, start - k), min(len(text), start + len(item) + k)
                own = places[at]
                if own and low <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(low, own[-1][0]), max(high, own[-1][1])
                else:
                    own.append([low, high])
        return places

    def matches(self, raw: str) -> list[dict]:
        """Best match of every item that the text contains."""
        text, out = normal(raw), []
        if not self.items or not text:
            return out
        for at, windows in self.windows(text).items():
            name, item, k = self.items[at]
            best = None
            for low, high in windows:
                if best and best[0] == 0:
                    break
                exact = text.find(item, low, high)
                hit = (0, exact - low, exact - low + len(item)) if exact >= 0 else find_item(item, text[low:high], k)
                if hit and (best is None or hit[0] < best[0]):
                    best = hit[0], low + hit[1], low + hit[2]
            if best:
                out.append({"item": name, "distance": best[0], "start": best[1], "end": best[2]})
        return sorted(out, key=lambda m: m["item"])


def _search(shared, chars_per_edit: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        searcher = Searcher(shared.value, chars_per_edit)
        kind = pa.list_(
            pa.struct([("item", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
        )
        for texts in batches:
            yield pa.array([searcher.matches(t.as_py() or "") for t in texts], kind)

    return run


def _item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[int, str]]]:
    """Items in parts of about ``limit`` bytes, each read by the driver on its own."""
    text = F.col(text_col).cast("string")
    known = items.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // limit))
    for part in range(parts):
        rows = known.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).collect()
        yield [(r["id"], r["text"]) for r in rows]


def find_benchmark(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    chars_per_edit: int = CHARS_PER_EDIT,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """Every row of ``docs`` with ``matches``: items, edit distance and range in the normalised text.

    Texts and items are compared in lower case with white space as single blanks. An item of n characters may differ
    by ``n // chars_per_edit`` edits. Items without id or text match nothing, nor do null or empty texts; of items
    with equal ids each match is listed. A document may match many items; the best place of each is given. Nothing is
    shuffled; documents are read once for each ``item_bytes`` of items.
    """
    spark = docs.sparkSession
    found = F.array().cast(MATCHES)
    for block in _item_blocks(items, item_id, item_text, item_bytes):
        if block:
            run = _search(spark.sparkContext.broadcast(block), chars_per_edit)
            # Called nondeterministic, or a filter on the matches would search every text a second time.
            search = F.arrow_udf(run, MATCHES).asNondeterministic()
            found = F.concat(found, search(F.col(text_col).cast("string")))
    return docs.withColumn("matches", found)

