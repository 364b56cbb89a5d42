import random
from collections import Counter

import pytest

from simmart import TableRules, check_constraints, distinct_by_key


def expand(rejects, columns):
    return Counter({tuple(r[c] for c in columns): 0 for r in []}) + sum(
        (Counter({tuple(r[c] for c in columns): r.copies}) for r in rejects), Counter()
    )


def test_good_and_rejects_make_the_input(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice(["a", "b", "c", None, "x" * 21]), rng.choice([None, 1, 2]), rng.choice(["u", "v", None]))
        for _ in range(300)
    ] + [("hot", 1, "u")] * 200
    df = spark.createDataFrame(rows, "id string, n int, ref string").repartition(6)
    refs = {"known": spark.createDataFrame([("u",)], "ref string")}
    rules = TableRules(key=["id"], not_null=["n"], max_length={"id": 20}, foreign={"ref": "known"})
    good, rejects = (f.collect() for f in check_constraints(df, rules, refs))
    kept = Counter(tuple(r) for r in good)
    assert kept + expand(rejects, df.columns) == Counter(rows)
    # per key the first row that passes the other rules stays; a NULL reference is no violation
    passing = [r for r in rows if r[0] and len(r[0]) <= 20 and r[1] is not None and r[2] in ("u", None)]
    first = {}
    for r in sorted(passing, key=lambda r: (r[1], r[2] is not None, r[2] or "")):
        first.setdefault(r[0], r)
    assert set(kept) == set(first.values())
    reasons = {tuple(r[c] for c in df.columns): r.reject_reason for r in rejects if not r.reject_reason.startswith("key")}
    assert reasons[None, None, "v"] == "null:id,null:n,fk:ref"
    assert any(r.reject_reason == "length:id" for r in rejects)
    assert any(r.reject_reason == "key:id" and r.id == "hot" and r.copies == 199 for r in rejects)


def test_no_rules_keeps_everything(spark):
    df = spark.range(5)
    good, rejects = check_constraints(df, TableRules())
    assert good.count() == 5 and rejects.count() == 0


def test_first_row_per_key(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", 2), (1, "a", 1), (2, None, 5)], "k int, s string, n int")
    assert {tuple(r) for r in distinct_by_key(df, ["k"]).collect()} == {(1, "a", 1), (2, None, 5)}
    assert distinct_by_key(df.select("k"), ["k"]).count() == 2
    assert distinct_by_key(df, ["s"]).columns == ["k", "s", "n"]


def test_repeated_reference_ids_and_absent_columns(spark):
    df = spark.createDataFrame([(1, "u"), (2, "v")], "k int, ref string")
    refs = {"known": spark.createDataFrame([("u",), ("u",)], "ref string")}
    good, rejects = check_constraints(df, TableRules(foreign={"ref": "known"}), refs)
    assert [tuple(r) for r in good.collect()] == [(1, "u")] and rejects.count() == 1
    for rules in (TableRules(not_null=["z"]), TableRules(max_length={"z": 3}), TableRules(key=["z"])):
        with pytest.raises(ValueError, match="z"):
            check_constraints(df, rules)
