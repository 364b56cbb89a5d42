"""Vector codes from codebooks fitted with anchors-hierarchy metric trees (operator 12).

Vectors are cut into equal parts; each part position has a codebook, and a part's code is its nearest entry. Fitting
moves entries to the means of the parts they own, some rounds long. All numbers are integers, so results don't depend
on how rows are dealt out.

A task builds one tree for each chunk of vectors and part position, once for all rounds. About sqrt(n) anchors come
first: a new anchor is the point farthest from its anchor and takes the points that are nearer to it, looking only at
points farther from their anchor than half the distance of the two. From that middle, anchors are merged upward, each
time the two with the smallest common ball, and large anchors are divided downward the same way. Every ball caches the
sum and count of its points. In a round, a ball inherits the list of entries that may own some of its points and drops
those that another entry beats everywhere in the ball; a ball with one entry left hands over its sum and count without a
look at its points. Only leaves with several entries compare points, with the entries of their list.

Chunks are independent, nothing of them but ``parts * entries`` sums a task is shuffled, and the driver holds the
codebooks only. Trees and vectors are stored once in the shared folder.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simmart.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Components of one chunk, and points that a leaf may have.
CHUNK_VALUES, LEAF = 1 << 18, 96
# More labels than this are joined instead of broadcast.
BROADCAST_LABELS = 50_000


# ---------------------------------------------------------------- trees


class Tree(NamedTuple):
    """Balls over the points ``order[start:end]``; children are numbers of balls, -1 for a leaf. Ball 0 is the root."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def _distances(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - point) ** 2).sum(1))


def _anchors(points: np.ndarray, members: np.ndarray) -> list[np.ndarray]:
    """Members dealt to about sqrt(n) anchors, each with its farthest points first."""
    wanted = math.ceil(math.sqrt(len(members)))
    away = _distances(points[members], points[members[0]])
    by_distance = np.argsort(-away, kind="stable")
    pivots, own, far = [members[0]], [members[by_distance]], [away[by_distance]]
    while len(own) < wanted:
        radii = np.array([f[0] for f in far])
        widest = int(radii.argmax())
        if radii[widest] == 0:
            break
        pivot = own[widest][0]
        between = _distances(points[pivots], points[pivot])
        taken, taken_far = [], []
        for o in np.nonzero(radii > between / 2)[0]:
            reach = np.searchsorted(-far[o], -between[o] / 2)  # points beyond half the distance
            new = _distances(points[own[o][:reach]], points[pivot])
            moves = new < far[o][:reach]
            if moves.any():
                taken.append(own[o][:reach][moves])
                taken_far.append(new[moves])
                stay = np.concatenate([~moves, np.ones(len(own[o]) - reach, bool)])
                own[o], far[o] = own[o][stay], far[o][stay]
        taken, taken_far = np.concatenate(taken), np.concatenate(taken_far)
        by_distance = np.argsort(-taken_far, kind="stable")
        pivots.append(pivot)
        own.append(taken[by_distance])
        far.append(taken_far[by_distance])
    return own


def _merge(points: np.ndarray, anchors: list[np.ndarray]) -> tuple:
    """Nested pairs of anchor numbers: the two balls with the smallest common ball join first."""
    counts = np.array([len(a) for a in anchors], float)
    centers = np.array([points[a].mean(0) for a in anchors])
    radii = np.array([_distances(points[a], c).max() for a, c in zip(anchors, centers)])
    names: list = list(range(len(anchors)))

    def common(i: int) -> np.ndarray:
        weight = counts / (counts + counts[i])
        away = _distances(centers, centers[i])
        out = np.maximum(away * (1 - weight) + radii, away * weight + radii[i])
        out[i] = np.inf
        return out

    table = np.array([common(i) for i in range(len(anchors))])
    for _ in range(len(anchors) - 1):
        i, j = divmod(int(table.argmin()), len(table))
        i, j = min(i, j), max(i, j)
        radii[i] = table[i, j]
        centers[i] = (centers[i] * counts[i] + centers[j] * counts[j]) / (counts[i] + counts[j])
        counts[i] += counts[j]
        names[i] = (names[i], names[j])
        counts[j], centers[j] = 0, np.inf
        table[j], table[:, j] = np.inf, np.inf
        with np.errstate(invalid="ignore"):
            row = np.where(counts > 0, common(i), np.inf)
        row[i] = np.inf
        table[i], table[:, i] = row, row
        last = names[i]
    return last if len(anchors) > 1 else names[0]


def build_tree(values: np.ndarray) -> Tree:
    """The tree of integer points, one row each."""
    points = values.astype(float)
    order, nodes = [], []  # nodes: [start, end, left, right]

    def node(start: int) -> int:
        nodes.append([start, start, -1, -1])
        return len(nodes) - 1

    def grow(members: np.ndarray) -> int:
        at = sum(map(len, order))
        anchors = _anchors(points, members) if len(members) > LEAF else []
        if len(anchors) < 2:
            own = node(at)
            order.append(members)
            nodes[own][1] = at + len(members)
            return own

        def place(name, start: int) -> int:
            if not isinstance(name, tuple):
                return grow(anchors[name])
            own = node(start)
            nodes[own][2] = place(name[0], start)
            nodes[own][3] = place(name[1], nodes[nodes[own][2]][1])
            nodes[own][1] = nodes[nodes[own][3]][1]
            return own

        return place(_merge(points, anchors), at)

    grow(np.arange(len(values)))
    ordered = np.concatenate(order)
    start, end, left, right = (np.array(c, np.int32) for c in zip(*nodes))
    running = np.concatenate([np.zeros((1, values.shape[1]), np.int64), values[ordered].cumsum(0, dtype=np.int64)])
    sums = running[end] - running[start]
    centers = sums / (end - start)[:, None]
    radius = np.array([_distances(points[ordered[s:e]], c).max() for s, e, c in zip(start, end, centers)])
    return Tree(ordered.astype(np.int32), start, end, left, right, radius, sums)


def owners(tree: Tree, values: np.ndarray, book: np.ndarray):
    """Which entry owns what: ``(balls, entries)`` of balls with one owner, ``(points, entries)`` of the rest.

    Equal distances go to the lower entry.
    """
    entries = book.astype(float)
    apart = np.sqrt(((entries[:, None] - entries) ** 2).sum(-1))
    first = np.array([(book[:e] != book[e]).any(1).all() for e in range(len(book))])  # a later equal entry owns nothing
    balls, lists = np.zeros(1, np.int64), first[None]
    whole, whole_entries, point_lists, points = [], [], [], []
    while len(balls):
        centers = tree.sums[balls] / (tree.end - tree.start)[balls, None]
        squares = ((centers[:, None] - entries) ** 2).sum(-1)
        nearest = np.where(lists, squares, np.inf).argmin(1)
        least = squares[np.arange(len(balls)), nearest][:, None]
        # the farthest that a point of the ball can favour an entry over the nearest one
        reach = 2 * tree.radius[balls, None] * apart[nearest]
        lists = lists & ~(least - squares + reach < -1e-9 * (least + squares + reach) - 1e-6)
        alone = lists.sum(1) == 1
        whole.append(balls[alone])
        whole_entries.append(nearest[alone])
        leaf = ~alone & (tree.left[balls] < 0)
        for ball, own in zip(balls[leaf], lists[leaf]):
            points.append(tree.order[tree.start[ball] : tree.end[ball]])
            point_lists.append(own)
        inner = ~alone & ~leaf
        balls, lists = np.concatenate([tree.left[balls[inner]], tree.right[balls[inner]]]), np.tile(lists[inner], (2, 1))
    found = [np.zeros(0, np.int64)]
    by_list: dict[bytes, list[int]] = {}
    for i, own in enumerate(point_lists):
        by_list.setdefault(own.tobytes(), []).append(i)
    rest = [np.zeros(0, np.int32)]
    for leaves in by_list.values():
        listed = np.nonzero(point_lists[leaves[0]])[0]
        own = np.concatenate([points[i] for i in leaves])
        squares = ((values[own].astype(np.int64)[:, None] - book[listed]) ** 2).sum(-1)
        rest.append(own)
        found.append(listed[squares.argmin(1)])
    return (np.concatenate(whole), np.concatenate(whole_entries)), (np.concatenate(rest), np.concatenate(found))


def entry_sums(tree: Tree, values: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the points that each entry owns."""
    sums, counts = np.zeros_like(book), np.zeros(len(book), np.int64)
    (balls, entries), (points, found) = owners(tree, values, book)
    np.add.at(sums, entries, tree.sums[balls])
    np.add.at(counts, entries, (tree.end - tree.start)[balls])
    np.add.at(sums, found, values[points].astype(np.int64))
    np.add.at(counts, found, 1)
    return sums, counts


def nearest_entries(tree: Tree, values: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The entry of every point."""
    out = np.empty(len(values), np.int64)
    (balls, entries), (points, found) = owners(tree, values, book)
    out[points] = found
    for ball, entry in zip(balls, entries):
        out[tree.order[tree.start[ball] : tree.end[ball]]] = entry
    return out


# ---------------------------------------------------------------- chunks

_TREE = pa.struct([("order", pa.binary()), ("nodes", pa.binary()), ("radius", pa.binary()), ("sums", pa.binary())])
_TREE_DDL = "array<struct<order: binary, nodes: binary, radius: binary, sums: binary>>"


def _pack(tree: Tree) -> dict:
    nodes = np.stack([tree.start, tree.end, tree.left, tree.right])
    return {"order": tree.order.tobytes(), "nodes": nodes.tobytes(), "radius": tree.radius.tobytes(), "sums": tree.sums.tobytes()}


def _unpack(packed: dict, width: int) -> Tree:
    nodes = np.frombuffer(packed["nodes"], np.int32).reshape(4, -1)
    sums = np.frombuffer(packed["sums"], np.int64).reshape(-1, width)
    return Tree(np.frombuffer(packed["order"], np.int32), *nodes, np.frombuffer(packed["radius"], float), sums)


def largest(dims: int) -> int:
    """Integers are held within this, so that the squared error of a vector fits a long."""
    return 1 << ((63 - max(1, math.ceil(math.log2(dims)))) // 2 - 1)


def _matrices(batch: pa.RecordBatch, parts: int, scale: int, chunk_values: int):
    """``(rows, integers)`` of the usable vectors of a batch, by length."""
    column = batch.column("vector")
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)  # null components are NaN
    starts = np.concatenate([[0], lengths.cumsum()])[:-1]
    for length in np.unique(lengths[(lengths > 0) & (lengths % parts == 0)]):
        rows = np.nonzero(lengths == length)[0]
        step = max(1, chunk_values // int(length))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            numbers = flat[starts[some][:, None] + np.arange(length)].astype(float)
            fine = np.isfinite(numbers).all(1)
            if fine.any():
                with np.errstate(over="ignore"):
                    whole = np.floor(scale * numbers[fine])
                bound = largest(int(length))
                yield some[fine], np.clip(whole, -bound, bound).astype(np.int32)


def _index(parts: int, entries: int, scale: int, chunk_values: int):
    def run(batches):
        for batch in batches:
            for rows, values in _matrices(batch, parts, scale, chunk_values):
                n, dims = values.shape
                ids, labels = (batch.column(c).take(pa.array(rows)) for c in ("id", "label"))
                names = ids.to_pylist()
                order = sorted(range(n), key=lambda i: (names[i] is None, 0 if names[i] is None else names[i], values[i].tolist()))
                width = dims // parts
                trees = [_pack(build_tree(values[:, p * width : (p + 1) * width])) for p in range(parts)]
                first = [{"id": names[i], "value": values[i].tolist()} for i in order[:entries]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([dims], pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids),
                        pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), labels),
                        pa.array([values.tobytes()], pa.binary()),
                        pa.array([trees], pa.list_(_TREE)),
                        pa.array([first], pa.list_(pa.struct([("id", ids.type), ("value", pa.list_(pa.int32()))]))),
                    ],
                    names=["dims", "ids", "labels", "values", "trees", "first"],
                )

    return run


def _chunks(batch: pa.RecordBatch, parts: int):
    """``(row, values, [(tree, values of the part)])`` of every stored chunk."""
    for row in range(batch.num_rows):
        dims = batch.column("dims")[row].as_py()
        values = np.frombuffer(batch.column("values")[row].as_py(), np.int32).reshape(-1, dims)
        width = dims // parts
        trees = [_unpack(t, width) for t in batch.column("trees")[row].as_py()]
        yield row, [(t, values[:, p * width : (p + 1) * width]) for p, t in enumerate(trees)]


def _sum_round(books: np.ndarray):
    def run(batches):
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, parts in _chunks(batch, len(books)):
                for p, (tree, values) in enumerate(parts):
                    s, c = entry_sums(tree, values, books[p])
                    sums[p] += s
                    counts[p] += c
        rows = [
            {"part": p, "entry": e, "n": int(counts[p, e]), "sums": sums[p, e].tolist()} for p, e in zip(*np.nonzero(counts))
        ]
        yield pa.RecordBatch.from_pylist(
            rows, pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
        )

    return run


def _code_round(books: np.ndarray):
    digits = np.array([f"{e:02x}" for e in range(books.shape[1])], object)

    def run(batches):
        for batch in batches:
            for row, parts in _chunks(batch, len(books)):
                code, error = np.array([""] * len(parts[0][1]), object), np.zeros(len(parts[0][1]), np.int64)
                for p, (tree, values) in enumerate(parts):
                    own = nearest_entries(tree, values, books[p])
                    code = code + digits[own]
                    error += ((values.astype(np.int64) - books[p][own]) ** 2).sum(1)
                ids, labels = (batch.column(c)[row].values for c in ("ids", "labels"))
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(code, pa.string()), pa.array(error)], names=["id", "label", "code", "error"]
                )

    return run


# ---------------------------------------------------------------- operator


class Coded(NamedTuple):
    """``codes``: ``(id, label, code, error)``; ``books``: integers by part, entry and position."""

    codes: DataFrame
    books: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def encode_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    chunk_values: int = CHUNK_VALUES,
) -> Coded:
    """Codes of vectors by codebooks fitted to all of them; further columns don't matter.

    A component x counts as ``floor(scale * x)``, held within what lets a squared error fit a long (2^27 for 64
    components). Each codebook starts as the parts of the smallest ids (ties by vector, null ids last), as many as there
    are up to ``entries``. In each round every entry that owns parts becomes the floor of their mean. Rows whose vector is null, holds null or
    non-finite components, or cannot be cut into ``parts`` equal parts are dropped, as are those of another length than
    the vector of the smallest id. Rows of one id are coded each for itself. A code has two hex digits a part.
    """
    kind = vectors.schema[vector_col].dataType
    vector = F.col(vector_col)
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))):
        vector = vector.cast("array<double>")
    own = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
    id_type, label_type = own.schema["id"].dataType, own.schema["label"].dataType
    schema = T.StructType(
        [
            T.StructField("dims", T.IntegerType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("labels", T.ArrayType(label_type)),
            *T.StructType.fromDDL(f"values binary, trees {_TREE_DDL}"),
            T.StructField("first", T.ArrayType(T.StructType.fromDDL("id int, value array<int>"))),
        ]
    )
    schema["first"].dataType.elementType["id"].dataType = id_type
    index = stage(own.mapInArrow(_index(parts, entries, scale, chunk_values), schema), "vector_trees")
    firsts = index.select("dims", F.explode("first").alias("f")).select("dims", "f.id", "f.value")
    lead = firsts.orderBy(F.col("id").asc_nulls_last(), "value").limit(1).collect()
    out = T.StructType([T.StructField("id", id_type), T.StructField("label", label_type), *T.StructType.fromDDL("code string, error bigint")])
    if not lead:
        return Coded(own.sparkSession.createDataFrame([], out), np.zeros((parts, 0, 0), np.int64))
    dims = lead[0].dims
    index = index.filter(F.col("dims") == dims)
    # at most ``entries`` rows
    start = firsts.filter(F.col("dims") == dims).orderBy(F.col("id").asc_nulls_last(), "value").limit(entries).collect()
    books = np.array([r.value for r in start], np.int64).reshape(len(start), parts, dims // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        partial = index.select("dims", "values", "trees").mapInArrow(
            _sum_round(books), "part int, entry int, n bigint, sums array<bigint>"
        )
        each = partial.select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
        # as many rows as the codebooks have numbers
        for r in each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
            books[r.part, r.entry, r["at"]] = r.s // r.n
    codes = stage(index.drop("first").mapInArrow(_code_round(books), out), "vector_codes")
    return Coded(codes, books)


def with_label_error(codes: DataFrame) -> DataFrame:
    """Coded rows and ``label_error``, the error summed over equal labels (nulls are one), at most the largest long."""
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    sums = codes.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "_label")
    sums = stage(sums, "label_errors")
    few = sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    same = F.col("label").eqNullSafe(F.col("_label"))
    return codes.join(F.broadcast(sums) if few else sums, same, "left").drop("_label")
