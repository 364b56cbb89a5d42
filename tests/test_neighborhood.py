import random

import pytest

import simmart as sm
from simmart.operators.neighborhood import edge_covers


def covered(mol, links, radius):
    """Node and round to the set of edges with an end within round - 1 steps."""
    near = {v: {v} for v in mol}
    out = {}
    for r in range(1, radius + 1):
        for v in mol:
            out[v, r] = frozenset(e for e in links if set(e) & near[v])
        near = {v: own.union(*(set(e) for e in links if set(e) & own)) for v, own in near.items()}
    return out


def graphs(seed):
    """Random graphs, a hub, and nodes without an edge; edges of two kinds, repeated, to themselves and to nowhere."""
    pick = random.Random(seed)
    nodes, edges, links = {}, [], {}
    for m in range(12):
        size = pick.randint(1, 7)
        nodes[m] = {v: pick.choice("CNO") for v in range(size)}
        links[m] = {tuple(sorted(pick.sample(range(size), 2))) for _ in range(pick.randint(0, 9)) if size > 1}
    nodes[99] = {v: "C" for v in range(40)}
    links[99] = {(0, v) for v in range(1, 40)} | {(1, 2)}
    for m, own in links.items():
        for a, b in own:
            kind = pick.choice("12")
            edges += [(m, a, b, kind), (m, b, a, kind)] * pick.choice((1, 2))
        edges += [(m, 0, 0, "1"), (m, 0, 777, "1")]
    return nodes, edges, links


@pytest.mark.parametrize("seed, radius", [(1, 2), (2, 3)])
def test_structural_duplicates_against_sets_of_edges(spark, seed, radius):
    nodes, edges, links = graphs(seed)
    n = spark.createDataFrame([(m, v, label) for m, own in nodes.items() for v, label in own.items()], "mol int, node int, label string")
    e = spark.createDataFrame(edges, "mol int, a int, b int, kind string")
    signs = {(r.mol, r.node, i): (r.n, r.high, r.low) for i, own in enumerate(edge_covers(n, e, radius), 1) for r in own.collect()}
    sets = {(m, v, r): own for m in nodes for (v, r), own in covered(nodes[m], links[m], radius).items() if own}
    assert signs.keys() == sets.keys()
    assert all(signs[k][0] == len(sets[k]) for k in sets)
    for m in nodes:
        mine = [k for k in sets if k[0] == m]
        assert all((signs[i] == signs[j]) == (sets[i] == sets[j]) for i in mine for j in mine)

    # hash of every node and round: what a radius adds to the one before
    found = sm.neighborhood_features(n, e, radius, structural_duplicates=False).collect()
    plain = [sm.neighborhood_features(n, e, r).collect() for r in range(radius + 1)]
    for m in nodes:
        own = [sorted(r.feature for r in rows if r.mol == m) for rows in [found, *plain]]
        distinct = {sets[k] for k in sets if k[0] == m}
        assert len(own[0]) == len(nodes[m]) + len(distinct)
        assert set(own[0]) <= set(own[-1]) and set(own[1]) <= set(own[0])


def test_earliest_round_then_smallest_hash_stays(spark):
    # a - b: both environments of both rounds cover the one edge
    n = spark.createDataFrame([("m", 0, "C"), ("m", 1, "N"), ("lone", 0, "C")], "mol string, node int, label string")
    e = spark.createDataFrame([("m", 0, 1, "1"), ("m", 1, 0, "1")], "mol string, a int, b int, kind string")
    rounds = [{(r.mol, r.feature) for r in sm.neighborhood_features(n, e, k).collect()} for k in (0, 1)]
    smallest = min(f for m, f in rounds[1] - rounds[0] if m == "m")
    found = sorted(map(tuple, sm.neighborhood_features(n, e, 2, structural_duplicates=False).collect()))
    assert found == sorted([*rounds[0], ("m", smallest)])


def test_no_edges_no_nodes(spark):
    n = spark.createDataFrame([], "mol string, node int, label string")
    e = spark.createDataFrame([], "mol string, a int, b int, kind string")
    assert sm.neighborhood_features(n, e, 2, structural_duplicates=False).collect() == []
    assert edge_covers(n, e, 0) == []


def test_triangles_and_few_steps(spark, monkeypatch):
    links = {(a, b) for a in range(6) for b in range(a + 1, 6)} | {(5, 6), (6, 7), (7, 8), (8, 6)}
    nodes = spark.createDataFrame([(1, v, "C") for v in range(9)], "mol int, node int, label string")
    edges = spark.createDataFrame([(1, a, b, "1") for a, b in links], "mol int, a int, b int, kind string")
    from simmart.operators import neighborhood

    stored = []
    monkeypatch.setattr(neighborhood, "stage", lambda df, label, keep=neighborhood.stage: stored.append(label) or keep(df, label))
    found = edge_covers(nodes, edges, 2)[1].collect()
    want = {v: len(own) for (v, r), own in covered(range(9), {tuple(sorted(e)) for e in links}, 2).items() if r == 2}
    assert {r.node: r.n for r in found} == want
    assert "near" not in stored  # radius 2 stores no pairs of nodes
