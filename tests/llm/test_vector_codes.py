"""Vector codes against distances of all parts to all entries."""

import hashlib
import math

import numpy as np
import pytest

from simmart.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """{(id, vector): (code, error)}, codebooks."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: np.array(v[p * width : (p + 1) * width], object)
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((int(((x - e) ** 2).sum()), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, members in own.items():
                books[p][k] = np.array([int(s) // len(members) for s in sum(members)], object)
    out = []
    for i, v, label in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


def check(spark, rows, kept=None, schema=SCHEMA, **kwargs):
    coded = vc.encode_vectors(spark.createDataFrame(rows, schema), **kwargs)
    got = [tuple(r) for r in vc.with_label_error(coded.codes).select("id", "label", "code", "error", "label_error").collect()]
    want, digest = plain([r[:3] for r in (rows if kept is None else kept)])
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    assert sorted(got, key=repr) == sorted(((*r, sums[r[1]]) for r in want), key=repr)
    assert coded.digest() == digest


def vectors(n, seed, spread=1.0, dims=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 1, (5, dims))
    return [
        (int(i), [float(x) for x in np.float32(centers[i % 5] + rng.normal(0, spread, dims))], int(i % 3) if i % 7 else None)
        for i in rng.permutation(n)
    ]


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_against_all_distances(spark, spread):
    check(spark, vectors(400, 3, spread), chunk_values=1500)


def test_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i // 2), [float(x) / 4096 for x in rng.integers(-2, 3, 8)], 1) for i in range(150)]
    check(spark, rows + [(500 + i, [0.0] * 8, i % 2) for i in range(100)])


def test_odd_rows(spark):
    good = vectors(20, 5)
    wide = [100.0] * 8 + [30_000.0] * 8
    rows = [
        (-9, None, 1), (-8, [1.0, None] * 8, 1), (-7, [float("nan")] * 16, 1), (-6, [float("inf")] * 16, 1), (-5, [], 1),
        (-4, [1.0] * 15, 1), (99, [1.0] * 8, 1),
    ]
    own = [*good, (None, wide, None), (None, [-x for x in wide], 2)]
    check(spark, [(*r, "x") for r in rows + own], own, SCHEMA + ", code string")
    few = vectors(3, 6)
    check(spark, few)
    empty = vc.encode_vectors(spark.createDataFrame([], SCHEMA))
    assert vc.with_label_error(empty.codes).collect() == [] and empty.digest() == hashlib.sha256(b"").hexdigest()


def test_balls_are_owned_whole():
    """On clustered points few are compared with entries; trees hold every point once and cache true sums."""
    rng = np.random.default_rng(8)
    centers = rng.integers(-4000, 4000, (16, 8))
    values = (centers[rng.integers(0, 16, 4000)] + rng.integers(-50, 50, (4000, 8))).astype(np.int32)
    tree = vc.build_tree(values)
    assert sorted(tree.order) == list(range(4000))
    for s, e, total in zip(tree.start, tree.end, tree.sums):
        assert (values[tree.order[s:e]].astype(np.int64).sum(0) == total).all()
    book = centers.astype(np.int64)
    (balls, _), (points, _) = vc.owners(tree, values, book)
    assert len(points) < 400 and len(balls) < 400
    direct = ((values[:, None].astype(np.int64) - book) ** 2).sum(-1).argmin(1)
    assert (vc.nearest_entries(tree, values, book) == direct).all()
