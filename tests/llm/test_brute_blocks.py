"""Operators 2 and 4 row by row against the plainest means."""

import random
from fractions import Fraction

from pyspark.sql import functions as F

from simmart.llm import decontaminate, mixing


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def least_distance(item, text):
    """Smallest edit distance between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def damaged(pick, item, n, letters):
    out = list(item)
    for _ in range(n):
        at = pick.randrange(len(out))
        kind = pick.randrange(3)
        if kind == 0:
            out[at] = pick.choice(letters)
        elif kind == 1:
            out.insert(at, pick.choice(letters))
        elif len(out) > 1:
            del out[at]
    return "".join(out)


def test_items_against_edit_distance(spark):
    """Every item in every text: found exactly when some part of the text is near enough, at the least distance."""
    pick = random.Random(4)
    items, texts = [], [None, "", "   ", "ab"]
    for n, letters in enumerate(["ab", "abc", "abcdefgh é", "ab c"] * 4):
        item = "".join(pick.choice(letters) for _ in range(pick.choice((1, 7, 16, 25, 40, 61, 90))))
        items.append((n, item))
        for edits in range(6):
            filler = ["".join(pick.choice(letters) for _ in range(pick.randrange(60))) for _ in range(3)]
            texts.append(filler[0] + damaged(pick, item, edits, letters) + filler[1] + damaged(pick, item, edits // 2, letters).upper() + filler[2])
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = 0
    for size in (2 << 20, 200):
        found = {r.doc_id: r.matches for r in decontaminate.find_benchmark(docs, table, item_bytes=size).collect()}
        for i, raw in enumerate(texts):
            text = decontaminate.normal(raw or "")
            want = {}
            for n, item in items:
                item = decontaminate.normal(item)
                least = least_distance(item, text) if item and text else None
                if least is not None and least <= decontaminate.edits(item):
                    want[n] = least
            assert {m.item: m.distance for m in found[i]} == want
            for m in found[i]:
                item = decontaminate.normal(items[m.item][1])
                assert distance(item, text[m.start : m.end]) == m.distance
            near += sum(d > 0 for d in want.values())
    assert near > 20


def test_rows_fall_into_the_blocks_of_their_bytes(spark, monkeypatch):
    """Rows by part, hash and id, their bytes counted one after another; places by the schedule of exact weights."""
    monkeypatch.setattr(mixing, "PART_ROWS", 7)
    pick = random.Random(2)
    rows = [(i, pick.choice(["a", "a", "a", "b", None]), pick.choice([None, "", "é" * pick.randrange(90), "x" * pick.randrange(400)])) for i in range(150)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    keys = {r.doc_id: r.key for r in table.select("doc_id", F.xxhash64("doc_id", F.lit(0)).alias("key")).collect()}
    parts, block = -(-len(rows) // 7), 300
    want, blocks = {}, {}
    for source in (None, "a", "b"):
        own = [(keys[i] % parts, keys[i], i, len((t or "").encode())) for i, s, t in rows if s == source]
        at, total = 0, sum(size for *_, size in own)
        blocks[source] = max(1, -(-total // block))
        for _, _, i, size in sorted(own):
            want[i] = min(at // block, blocks[source] - 1)
            at += size
    weights = {None: 0.2, "a": 0.5, "b": 0.3}
    # sources by name, null first
    plan = mixing.schedule({n: Fraction(weights[s]) for n, s in enumerate(blocks)}, dict(enumerate(blocks.values())))
    slots = {s: plan[n] for n, s in enumerate(blocks)}
    got = mixing.mix_sources(table, weights, block_bytes=block).collect()
    assert len(got) == len(rows) and min(blocks.values()) > 3
    for r in got:
        assert (r.mix_block, r.mix_slot) == (want[r.doc_id], slots[r.source][want[r.doc_id]])
    assert sorted(p for own in slots.values() for p in own) == list(range(sum(blocks.values())))
