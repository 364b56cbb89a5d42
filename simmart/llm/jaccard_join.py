"""Links between documents with similar sets of word shingles, as components (operator 10).

A token-group matrix: similar documents form groups of bounded size, a group stores the union of its tokens, and only
groups whose union covers enough of a document's tokens are opened and compared.

1. Every chunk of documents learns from shards how many sets hold each of its shingles. A set of n shingles can only be
   linked when at least ``percent`` of them stand in another set too; most unique texts end here.
2. Equal sets are one class. Classes with the same smallest or largest shared shingle form families; blocks of a family
   and its first member are compared inside, which links most copies.
3. Groups are blocks of a component or family. Two groups of different components can only contain a link when they
   share a token among the rarest ones of a member (prefix filter). Members whose tokens the other group's union does
   not cover are left out, the others are compared by one product of 0/1 matrices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simmart.llm.blocks import (
    frame,
    in_chunks,
    joined,
    mix,
    pack_bytes,
    pack_sorted,
    rolling,
    shard_ranges,
    short_hashes,
    texts_of,
    unpack_bytes,
    unpack_sorted,
    word_hashes,
)
from simmart.llm.components import components
from simmart.session import stage

WORDS, PERCENT = 5, 80
# Members of one group. More members of a component or family make more groups.
GROUP = 128
# Columns of one matrix product.
COLUMNS = 20_000
# Bytes of text for one word, to choose the number of bits of a filter hash.
WORD_BYTES = 6

_BASE = 0xD1342543DE82EF95
_SHORT = np.uint64(0xA0761D6478BD642F)
_BLOBS = pa.schema(
    [("shard", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("sets", pa.binary())]
)
_REPLIES = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("common", pa.binary())])
_PROFILE = pa.schema(
    [
        ("id", pa.int64()),
        ("n", pa.int64()),
        ("key1", pa.int64()),
        ("key2", pa.int64()),
        ("tokens", pa.binary()),
        ("prefix", pa.int32()),
        ("low", pa.int64()),
        ("high", pa.int64()),
    ]
)
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


# ---------------------------------------------------------------- sets of a chunk


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Ascending distinct hashes of the shingles of each text; fewer words than ``width`` are one shingle."""
    words, counts = word_hashes([t.lower() for t in texts])
    sets, at = [], 0
    ends = np.arange(len(words) - width + 1)
    every = rolling(words, ends, ends + width, _BASE) if len(words) >= width else np.zeros(0, np.uint64)
    for n in counts.tolist():
        if n >= width:
            sets.append(np.unique(every[at : at + n - width + 1]))
        elif n:
            whole = rolling(words[at : at + n], np.array([0]), np.array([n]), _BASE)
            sets.append(mix(whole ^ (_SHORT + np.uint64(n))))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += n
    return sets


def _keys(own: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    return tuple(int(mix(own ^ c).sum(dtype=np.uint64).view(np.int64)) for c in (np.uint64(1), _SHORT))


def _classes(table: pa.Table, width: int) -> tuple[list, list[np.ndarray], list[tuple[int, int]], list[int]]:
    """Ids, sets and keys of the rows of a chunk; rows that are the first of their set (rows without id never are)."""
    _, ids, texts = texts_of(table)
    sets = shingle_sets(texts, width)
    keys = [_keys(s) for s in sets]
    seen, first = set(), []
    for i, key in enumerate(keys):
        if len(sets[i]) and ids[i] is not None and key not in seen:
            seen.add(key)
            first.append(i)
    return ids, sets, keys, first


def _distinct(sets: list[np.ndarray], first: list[int], total: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cut hashes of a chunk and the number of sets (at most 255) that hold each."""
    every = np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in first)])
    values, counts = np.unique(short_hashes(every, total, WORD_BYTES), return_counts=True)
    return values, np.minimum(counts, 255).astype(np.uint8)


def _send(width: int, total: int, shard_bits: int):
    def run(table: pa.Table) -> pa.Table:
        _, sets, _, first = _classes(table, width)
        values, counts = _distinct(sets, first, total)
        ranges = shard_ranges(values, shard_bits)
        return frame(
            _BLOBS,
            shard=[s for s, _, _ in ranges],
            chunk=[table["chunk"][0].as_py()] * len(ranges),
            n=[b - a for _, a, b in ranges],
            hashes=[pack_sorted(values[a:b]) for _, a, b in ranges],
            sets=[pack_bytes(counts[a:b]) for _, a, b in ranges],
        )

    return run


def _answer(table: pa.Table) -> pa.Table:
    """For every hash of every blob the binary logarithm of the number of sets that hold it (0: only one)."""
    sizes = table["n"].to_pylist()
    values = np.concatenate([unpack_sorted(b, n) for b, n in zip(table["hashes"].to_pylist(), sizes)])
    counts = np.concatenate([unpack_bytes(b, n) for b, n in zip(table["sets"].to_pylist(), sizes)])
    order = np.argsort(values, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], values[order][1:] != values[order][:-1]]))
    sums = np.add.reduceat(counts[order].astype(np.int64), begin)
    common = np.empty(len(values), np.uint8)
    common[order] = np.repeat(np.log2(sums).astype(np.uint8), np.diff([*begin, len(values)]))
    cuts = np.cumsum([0, *sizes])
    return frame(
        _REPLIES,
        chunk=table["chunk"].to_pylist(),
        shard=table["shard"].to_pylist(),
        common=[pack_bytes(common[a:b]) for a, b in zip(cuts, cuts[1:])],
    )


def needed(n: np.ndarray | int, percent: int):
    """Fewest common shingles of a set of n with any set it is linked to."""
    return -(-percent * n // 100)


def _profile(width: int, percent: int, total: int, shard_bits: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _PROFILE.empty_table()
        ids, sets, keys, first = _classes(table, width)
        values, _ = _distinct(sets, first, total)
        common = joined(replies, "common", len(values), shard_ranges(values, shard_bits))
        n = len(ids)
        tokens, prefix, low, high = [None] * n, [None] * n, [None] * n, [None] * n
        for i in first:
            own = sets[i]
            rank = common[np.searchsorted(values, short_hashes(own, total, WORD_BYTES))]
            live = own[rank > 0]
            least = needed(len(own), percent)
            if len(live) >= least:
                # Rarest first; the same order everywhere, so linked sets share a token of their prefixes.
                tokens[i] = live[np.argsort(rank[rank > 0], kind="stable")].tobytes()
                prefix[i] = len(live) - least + 1
                low[i], high[i] = int(live[0].view(np.int64)), int(live[-1].view(np.int64))
        return frame(
            _PROFILE,
            id=ids,
            n=[len(s) for s in sets],
            key1=[k[0] if len(s) else None for k, s in zip(keys, sets)],
            key2=[k[1] if len(s) else None for k, s in zip(keys, sets)],
            tokens=tokens,
            prefix=prefix,
            low=low,
            high=high,
        )

    return run


# ---------------------------------------------------------------- comparison


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a bounded number of sets, by products of 0/1 matrices."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, counts = np.unique(every, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts > 1)
    place = np.full(len(values), -1)
    place[shared] = np.arange(len(shared))
    column = place[column]
    owner, column = owner[column >= 0], column[column >= 0]
    out = np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, len(shared), COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        matrix = np.zeros((len(sets), min(COLUMNS, len(shared) - begin)), np.float32)
        matrix[owner[a:b], column[a:b] - begin] = 1
        out += matrix @ matrix.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _stars(ids: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links among a bounded number of sets, as ``(id, smallest id of its component)``."""
    common = _common(sets)
    union = sizes[:, None] + sizes[None, :] - common
    linked = 100 * common >= percent * union
    root = np.arange(len(ids))[np.argsort(np.argsort(ids))]  # rank of each id
    rank = root.copy()
    while True:
        new = np.where(linked, root[None, :], len(ids)).min(axis=1)
        new = np.minimum(new, root)
        if (new == root).all():
            break
        root = new
    by_rank = np.sort(ids)
    return [(int(i), int(by_rank[r])) for i, r, own in zip(ids, root, rank) if r != own]


def _links(pairs: list[tuple[int, int]]) -> pa.Table:
    return frame(_LINKS, a=[a for a, _ in pairs], b=[b for _, b in pairs])


def _sets_of(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(t, np.uint64) for t in table["tokens"].to_pylist()]


def _inside(percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids, n = (np.array(table[c].to_pylist(), np.int64) for c in ("id", "n"))
        return _links(_stars(ids, n, _sets_of(table), percent))

    return run


_GROUPS = pa.schema(
    [
        ("gid", pa.int64()),
        ("label", pa.int64()),
        ("members", pa.int32()),
        ("ids", pa.binary()),
        ("n", pa.binary()),
        ("lengths", pa.binary()),
        ("tokens", pa.binary()),
        ("prefixes", pa.list_(pa.int64())),
    ]
)


def _group(table: pa.Table) -> pa.Table:
    """One group: its members, their tokens as places in the token union, and the tokens of all prefixes."""
    sets = _sets_of(table)
    union, back = np.unique(np.concatenate(sets), return_inverse=True)
    parts = {
        "ids": np.array(table["id"].to_pylist(), np.int64),
        "n": np.array(table["n"].to_pylist(), np.int64),
        "lengths": np.array([len(union), *map(len, sets)], np.int64),
    }
    prefixes = np.unique(np.concatenate([s[:p] for s, p in zip(sets, table["prefix"].to_pylist())]))
    return frame(
        _GROUPS,
        gid=[table["gid"][0].as_py()],
        label=[table["label"][0].as_py()],
        members=[len(sets)],
        tokens=[pack_bytes(np.concatenate([union, back.astype(np.uint64)]))],
        prefixes=[prefixes.view(np.int64)],
        **{k: [v.tobytes()] for k, v in parts.items()},
    )


class Group:
    def __init__(self, ids: bytes, n: bytes, lengths: bytes, tokens: bytes):
        self.ids, self.n = np.frombuffer(ids, np.int64), np.frombuffer(n, np.int64)
        size, *each = np.frombuffer(lengths, np.int64).tolist()
        raw = unpack_bytes(tokens, size + sum(each), np.uint64)
        self.union, self.owner = raw[:size], np.repeat(np.arange(len(each)), each)
        self.place = raw[size:].astype(np.int64)
        self.cuts = np.cumsum([0, *each])

    def open(self, other: np.ndarray, percent: int) -> np.ndarray:
        """Members that may be linked to a set inside the token union of another group."""
        covered = np.isin(self.union, other, assume_unique=True)[self.place]
        return np.flatnonzero(np.bincount(self.owner[covered], minlength=len(self.ids)) >= needed(self.n, percent))

    def sets(self, members: np.ndarray) -> list[np.ndarray]:
        return [self.union[self.place[self.cuts[m] : self.cuts[m + 1]]] for m in members]


def _across(percent: int):
    columns = ("ids", "n", "lengths", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = batch.to_pylist(), []
            for row in rows:
                a, b = (Group(*(row[f"{c}_{side}"] for c in columns)) for side in "ab")
                own, theirs = a.open(b.union, percent), b.open(a.union, percent)
                if row["gid_a"] == row["gid_b"]:
                    theirs = theirs[:0]
                elif not len(own) or not len(theirs):
                    continue
                if len(own) + len(theirs) > 1:
                    ids, n = np.concatenate([a.ids[own], b.ids[theirs]]), np.concatenate([a.n[own], b.n[theirs]])
                    out += _stars(ids, n, a.sets(own) + b.sets(theirs), percent)
            yield from _links(out).to_batches()

    return run


# ---------------------------------------------------------------- plan


def _blocked(classes: DataFrame, keys: list[str], with_first: bool) -> DataFrame:
    """Classes with the block of their key, at most about ``GROUP`` in each; the first one of a key is in all blocks."""
    sizes = classes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("id").alias("_first"))
    if with_first:
        sizes = sizes.filter("_n > 1")
    sizes = sizes.withColumn("_parts", F.ceil(F.col("_n") / GROUP).cast("int"))
    blocked = classes.join(sizes, keys)
    part = F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int")
    if with_first:
        blocks = F.when(F.col("id") == F.col("_first"), F.sequence(F.lit(0), F.col("_parts") - 1)).otherwise(F.array(part))
        blocked = blocked.withColumn("block", F.explode(blocks))
    else:
        blocked = blocked.withColumn("block", part)
    return blocked.drop("_n", "_first", "_parts")


def _pairs(groups: DataFrame) -> DataFrame:
    """Groups that share a prefix token and are not both of one component; a mixed group also with itself."""
    entries = groups.select("gid", "label", F.explode("prefixes").alias("token"))
    a, b = (entries.select("token", F.col("gid").alias(f"gid_{s}"), F.col("label").alias(f"label_{s}")) for s in "ab")
    shared = a.join(b, "token").filter("gid_a < gid_b AND (label_a IS NULL OR label_b IS NULL OR label_a <> label_b)")
    own = groups.filter("label IS NULL AND members > 1").select(F.col("gid").alias("gid_a"), F.col("gid").alias("gid_b"))
    return shared.select("gid_a", "gid_b").distinct().unionByName(own)


def join_similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    **sizes,
) -> DataFrame:
    """``(id, n_shingles, component_id)`` of every row: the smallest id it reaches by links.

    Two rows are linked when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct shingles of ``words``
    words, A-Z in lower case; fewer words are one shingle. Rows without words have size 0, are linked with nothing and
    are their own component. Rows without id are linked with nothing and have no component. Rows with equal ids are
    one node. Shingles are 64-bit hashes.
    """
    chunks, layout = in_chunks(docs, id_col, text_col, False, **sizes)
    chunks = chunks.withColumn("id", F.col("id").cast("long"))
    total, bits = layout.bytes, layout.shard_bits
    blobs = chunks.groupBy("chunk").applyInArrow(
        _send(words, total, bits), "shard int, chunk int, n int, hashes binary, sets binary"
    )
    replies = blobs.groupBy("shard").applyInArrow(_answer, "chunk int, shard int, common binary")
    profile = (
        chunks.groupBy("chunk")
        .cogroup(replies.groupBy("chunk"))
        .applyInArrow(
            _profile(words, percent, total, bits),
            "id long, n long, key1 long, key2 long, tokens binary, prefix int, low long, high long",
        )
    )
    profile = stage(profile, "profile")
    named = profile.filter("n > 0 AND id IS NOT NULL")
    classes = named.groupBy("key1", "key2").agg(F.min("id").alias("class"))

    # One row for each set that can be linked at all.
    able = named.filter("tokens IS NOT NULL").groupBy("key1", "key2")
    able = able.agg(F.min("id").alias("id"), *(F.any_value(c).alias(c) for c in ("n", "tokens", "prefix", "low", "high")))
    able = stage(able.drop("key1", "key2"), "classes")

    links = None
    for key in ("low", "high"):
        family = _blocked(able.select("id", "n", "tokens", key), [key], True).groupBy(key, "block")
        own = family.applyInArrow(_inside(percent), "a long, b long")
        links = own if links is None else links.unionByName(own)
    near = stage(links, "links")
    labels = components(near)

    # Components and the families of what is left become groups.
    sorted_in = able.join(labels.withColumnRenamed("node", "id"), "id", "left")
    sorted_in = sorted_in.withColumn("family", F.when(F.col("label").isNull(), F.col("low")).otherwise(F.lit(0)))
    sorted_in = sorted_in.withColumn("own", F.xxhash64(F.coalesce("label", F.lit(-1)), "family", F.col("label").isNull()))
    blocked = _blocked(sorted_in.drop("low", "high", "family"), ["own"], False)
    blocked = blocked.withColumn("gid", F.xxhash64("own", "block"))
    groups = blocked.groupBy("gid").applyInArrow(
        _group,
        "gid long, label long, members int, ids binary, n binary, lengths binary, tokens binary, prefixes array<long>",
    )
    groups = stage(groups, "groups")
    pairs = _pairs(groups)
    for side in "ab":
        kept = groups.select(*(F.col(c).alias(f"{c}_{side}") for c in ("gid", "ids", "n", "lengths", "tokens")))
        pairs = pairs.join(kept, f"gid_{side}")
    more = stage(pairs.mapInArrow(_across(percent), "a long, b long"), "links")
    if not more.isEmpty():
        known = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = components(known.unionByName(more))

    found = profile.select("id", "n", "key1", "key2").join(classes, ["key1", "key2"], "left")
    found = found.join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("label", "class", "id"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
