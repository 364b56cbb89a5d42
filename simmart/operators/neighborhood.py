"""Circular-neighbourhood features of labelled graphs held in two tables.

Method: Morgan (1965), Rogers and Hahn, "Extended-connectivity fingerprints" (2010). The hash is our own, so the
bits are not those of any chemistry toolkit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simmart.schemas import N_BITS, RADIUS
from simmart.session import stage

# Number of hashes and the two halves of their sum.
SUM = ("n", "high", "low")


def short_hash(text: Column) -> Column:
    """The first 60 bits of the md5, as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def neighborhood_features(
    nodes: DataFrame, edges: DataFrame, radius: int = RADIUS, structural_duplicates: bool = True
) -> DataFrame:
    """``(mol, feature)``: one hash per node and round 0..radius.

    ``nodes`` is ``(mol, node, label)``, one row per node; ``edges`` is ``(mol, a, b, kind)`` and makes ``b`` a
    neighbour of ``a``. Edges to unknown nodes are ignored. Hand in stored tables; nodes are read several times.

    Without ``structural_duplicates``, environments of round 1 and later that cover the same edges of their graph count
    once: the one of the earliest round stays, of those the one with the smallest hash. Those that cover no edge go.

    The neighbours of a node enter as their number and the sum of their hashes. A sum does not depend on the order and
    combines before the shuffle, so a hub with very many edges never has its neighbours gathered in one place. The sum
    is kept in two halves of 30 bits, which leaves room for 2**33 neighbours. Each round is stored once, as one hash
    per node: the next round reads it twice and the result once more.
    """
    state = nodes.select("mol", "node", short_hash(F.col("label")).alias("hash"))
    rounds = [state]
    for done in range(radius):
        neighbour = state.select("mol", F.col("node").alias("b"), F.col("hash").alias("theirs"))
        met = edges.join(neighbour, ["mol", "b"]).select(
            "mol", F.col("a").alias("node"), short_hash(F.concat_ws(":", "kind", "theirs")).alias("term")
        )
        gathered = _sum_of(met, "term")
        sums = [F.coalesce(F.col(c), F.lit(0)) for c in SUM]
        state = stage(
            state.join(gathered, ["mol", "node"], "left").select(
                "mol", "node", short_hash(F.concat_ws(",", "hash", *sums)).alias("hash")
            ),
            "neighborhood",
        )
        rounds.append(state)
    features = [own.select("mol", F.col("hash").alias("feature")) for own in rounds]
    if structural_duplicates or not radius:
        return reduce(DataFrame.union, features)
    signed = [
        own.join(cover, ["mol", "node"]).withColumn("round", F.lit(i))
        for i, (own, cover) in enumerate(zip(rounds[1:], edge_covers(nodes, edges, radius)), 1)
    ]
    first = F.min(F.struct("round", "hash")).alias("first")
    kept = reduce(DataFrame.union, signed).groupBy("mol", *SUM).agg(first)
    return features[0].union(kept.select("mol", "first.hash"))


def _sum_of(terms: DataFrame, column: str) -> DataFrame:
    """Number of the 60-bit hashes of every ``(mol, node)`` and their sum in two halves."""
    return terms.groupBy("mol", "node").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftright(column, 30)).alias("high"),
        F.sum(F.col(column).bitwiseAND(F.lit((1 << 30) - 1))).alias("low"),
    )


def edge_covers(nodes: DataFrame, edges: DataFrame, radius: int = RADIUS) -> list[DataFrame]:
    """For each round 1..radius ``(mol, node, n, high, low)``: number and sum of hashes of the edges that an environment covers.

    Edges count once for two nodes, whatever their kind and direction; those from a node to itself and those to unknown
    nodes cover nothing, and nodes without an edge have no row. Round r covers the edges with an end within r - 1
    steps, so two environments of one graph with equal rows cover the same edges (but for hashes whose sums agree).

    The edges themselves are never listed by environment: the sums of all nodes within reach are added up, and edges
    with both ends there, which are in two of these sums, are taken off once. Such edges are searched from their end
    of lower degree, so a hub with very many edges costs no more than the edges it has. Rounds 1 and 2 need nothing but
    the edges; from round 3 on, pairs of nodes within r - 1 steps are stored.
    """
    known = nodes.select("mol", "node")
    lower, upper = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    single = edges.filter("a <> b").select("mol", lower, upper).distinct()
    for end in ("a", "b"):
        single = single.join(known.withColumnRenamed("node", end), ["mol", end], "left_semi")
    bonds = stage(single.select("mol", "a", "b", short_hash(F.concat_ws(",", "a", "b")).alias("hash")), "bonds")
    arcs = bonds.select("mol", "a", "b", "hash").union(bonds.select("mol", "b", "a", "hash"))
    at_node = stage(_sum_of(arcs.withColumnRenamed("a", "node"), "hash"), "at_node")
    covers = [at_node]
    if radius < 2:
        return covers[:radius]
    degree = at_node.select("mol", "node", "n")
    ranked = bonds.join(degree.toDF("mol", "a", "n_a"), ["mol", "a"]).join(degree.toDF("mol", "b", "n_b"), ["mol", "b"])
    low_first = F.struct("n_a", "a") <= F.struct(F.col("n_b").alias("n_a"), F.col("b").alias("a"))
    upward = stage(
        ranked.select("mol", F.when(low_first, F.col("a")).otherwise(F.col("b")).alias("a"),
                      F.when(low_first, F.col("b")).otherwise(F.col("a")).alias("b"), "hash"),
        "upward",
    )
    steps = arcs.select("mol", "a", "b")
    # Round 2: the node itself and its neighbours. Of the edges with both ends there, those at the node make up its own
    # sum, which takes that sum off again; the others close triangles, each found once from its lowest end.
    around = steps.join(at_node.withColumnRenamed("node", "b"), ["mol", "b"]).select("mol", F.col("a").alias("node"), *SUM)
    one, other = upward.select("mol", "a", "b", "hash"), upward.toDF("mol", "a", "c", "other")
    wedges = one.join(other, ["mol", "a"]).filter("b < c")
    closed = wedges.join(bonds.toDF("mol", "b", "c", "third"), ["mol", "b", "c"])
    corners = (F.struct(F.col(end).alias("node"), F.col(edge).alias("hash")) for end, edge in (("a", "third"), ("b", "other"), ("c", "hash")))
    opposite = closed.select("mol", F.inline(F.array(*corners)))
    parts = around.union(_negative(_sum_of(opposite, "hash")))
    covers.append(stage(_added(parts), "cover"))
    if radius == 2:
        return covers
    near = at_node.select("mol", "node", F.col("node").alias("a")).union(arcs.select("mol", "a", "b"))
    for _ in range(3, radius + 1):
        onward = near.join(steps, ["mol", "a"]).select("mol", "node", F.col("b").alias("a"))
        near = stage(near.union(onward).distinct(), "near")
        all_sums = near.join(at_node.withColumnRenamed("node", "a"), ["mol", "a"])
        inside = near.join(upward, ["mol", "a"]).join(near.withColumnRenamed("a", "b"), ["mol", "node", "b"], "left_semi")
        parts = all_sums.select("mol", "node", *SUM).union(_negative(_sum_of(inside, "hash")))
        covers.append(stage(_added(parts), "cover"))
    return covers


def _negative(sums: DataFrame) -> DataFrame:
    return sums.select("mol", "node", *(F.negative(c).alias(c) for c in SUM))


def _added(sums: DataFrame) -> DataFrame:
    return sums.groupBy("mol", "node").agg(*(F.sum(c).alias(c) for c in SUM))


def fold_features(features: DataFrame, n_bits: int = N_BITS) -> DataFrame:
    """Fold ``(mol, feature)`` rows into ``(chembl_id, on, pop)``; at most ``n_bits`` positions meet per molecule."""
    bit = F.pmod("feature", F.lit(n_bits)).cast("int").alias("bit")
    folded = (
        features.select("mol", bit)
        .distinct()
        .groupBy(F.col("mol").alias("chembl_id"))
        .agg(F.sort_array(F.collect_list("bit")).alias("on"))
    )
    return folded.select("chembl_id", "on", F.size("on").alias("pop"))
