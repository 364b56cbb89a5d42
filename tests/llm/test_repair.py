"""Conversation repair against every edit string of short conversations, and its odd rows."""

import itertools
import random
import re

import pytest

from simmart.llm import conversation_repair as cr
from tests.llm.brute import sha

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0d]+$", "", text)
        out.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, turns) by trying all edits of all rows, with up to two inserts at every place."""
    places = [c for n in range(3) for c in itertools.product(("user", "assistant"), repeat=n)]
    edits = []
    for (role, text), fault in zip(rows, faults(rows)):
        own = [(3, "D", None)]
        if fault not in ("b", "d"):
            more = fault == "t"
            own.append((more, "K", (role, text)))
            own += [(2 + more, "R", (r, text)) for r in ("user", "assistant")]
        edits.append(own)
    best = None
    for inserts in itertools.product(places, repeat=len(rows) + 1):
        for chosen in itertools.product(*edits):
            cost, audit, turns = 0, "", []
            for k in range(len(rows) + 1):
                cost, audit = cost + 2 * len(inserts[k]), audit + "I" * len(inserts[k])
                turns += [(r, "") for r in inserts[k]]
                if k < len(rows):
                    cost, audit = cost + chosen[k][0], audit + chosen[k][1]
                    turns += [chosen[k][2]] if chosen[k][2] else []
            if best is None or (cost, audit) < best[:2]:
                if GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in turns)):
                    best = cost, audit, turns
    return best


def run(spark, rows, schema=SCHEMA, **kwargs):
    found = cr.repair(spark.createDataFrame(rows, schema), **kwargs)
    digests = {r.conv_id: r.sha256 for r in cr.text_digests(found.spans).collect()}
    turns = {}
    for t in sorted(found.turns.collect(), key=lambda t: (t.conv_id is None, t.conv_id or 0, t.place)):
        own = turns.setdefault(t.conv_id, [])
        assert t.place == len(own)
        own.append((t.role, t.text))
    return {r.conv_id: r for r in found.conversations.collect()}, turns, digests


def test_against_all_edits(spark):
    rng = random.Random(11)
    texts = ["yes.", "no", "", " \t", "why? ", "yes."]
    rows = [
        (c, t, rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(texts)) for c in range(24) for t in range(c % 3 + 1)
    ]
    found, turns, digests = run(spark, rows)
    assert set(found) == set(range(24))
    for c in range(24):
        own = [(r, x) for i, _, r, x in sorted(rows) if i == c]
        cost, audit, want = cheapest(own)
        row, kinds = found[c], faults(own)
        assert (row.cost, row.audit, turns.get(c, [])) == (cost, audit, want)
        assert (row.blank, row.duplicate, row.truncated) == tuple(kinds.count(k) for k in "bdt")
        pairs = [(a or "-")[0] + (b or "-")[0] for (a, _), (b, _) in zip(own, own[1:])]
        assert row.illegal == sum(p not in ("su", "ua", "au") for p in pairs)
        assert digests[c] == sha("\n".join(f"{r}:{x}" for r, x in want))


def test_odd_rows(spark):
    rows = [
        (None, None, "user", "a."), (None, 3, "assistant", "b."), (None, 3, "assistant", "b."),
        (1, None, None, None), (2, 5, "user", "q?"), (2, 9, "assistant", "x" * 300_000 + "."), (2, None, "system", "s."),
    ]
    found, turns, _ = run(spark, rows)
    assert (found[None].duplicate, found[None].audit, found[None].gaps) == (1, "KKD", 0)
    assert (found[1].blank, found[1].audit, found[1].cost, found[1].gaps) == (1, "D", 3, 0)
    assert (found[2].audit, found[2].gaps) == ("KKK", 3) and len(turns[2][2][1]) == 300_001
    assert run(spark, [])[0] == {}


def test_dropped_rows_and_extra_columns(spark):
    rows = [(1, 0, "user", "a.", 0, "x"), (2, 0, "user", "a.", 2, "y"), (2, 1, "assistant", "b.", 1, "z")]
    found, turns, digests = run(spark, rows, schema=SCHEMA + ", copies long, fault string")
    assert (found[1].audit, found[1].cost, found[1].gaps, digests[1]) == ("", 0, 0, sha(""))
    assert (found[2].audit, found[2].illegal, turns[2]) == ("KDK", 1, [("user", "a."), ("assistant", "b.")])


@pytest.mark.parametrize("rows_each", [7, 512])
def test_long_conversation_in_many_spans(spark, rows_each):
    """Spans of several tasks join to what one chart over all rows gives."""
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", f"c{t}.", ""])) for t in range(3000)]
    rows += [(8, 0, "user", "hi.")] * 1500
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found, turns, digests = run(spark, rows, span_rows=rows_each)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    own = [(r, x) for i, _, r, x in sorted(rows, key=lambda r: r[:2]) if i == 7]
    code = {"": cr.SOUND, "b": cr.BLANK, "d": cr.DUPLICATE, "t": cr.TRUNCATED}
    cells = [cr.leaf(cr.initial_of(r), code[f]) for (r, _), f in zip(own, faults(own))]
    left_to_right = cr.INSERTS
    for cell in cells:
        left_to_right = cr.combine(left_to_right, cell)
    cost, audit = cr.best_whole(left_to_right)
    want = [(t["role"], t["text"]) for t in cr.replay([{"role": r, "text": x} for r, x in own], audit, cr.START)[0]]
    assert (found[7].cost, found[7].audit, turns[7]) == (cost, audit, want)
    assert digests[7] == sha("\n".join(f"{r}:{x}" for r, x in want))
    assert (found[8].duplicate, found[8].illegal) == (1499, 1499)
    assert found[8].cost == 3 * 1499 + 2 and len(found[8].audit) == 1501
