"""Near-duplicate vectors by comparing packed tiles, every link confirmed exactly.

Equal vectors become one class with a count.  Classes are put in the order of a tree of
hyperplanes fitted to a sample, so that near vectors lie together, and packed: a row holds
a tile of vectors.  Every pair of tiles of one length whose balls come near enough is
compared once, by a Cartesian product that reads the packed tiles again from the shared
folder: nothing is copied for it, so the disk follows the input, not its square.

Two tiles are compared in squares of bounded size.  Two balls too far apart have no links,
two that lie together closely have all of them.  In other squares a rotation, which keeps
products, goes first: of unit vectors x and y in leading coordinates and the length of the
rest, x . y <= x1 . y1 + |x2| |y2|, so what stays below the cosine there is no link, and the
few others are computed in full.  A task adds up its link counts and gives back a spanning
forest, never the pairs, so a group of n near copies costs a task at most n rows.
"""

from __future__ import annotations

import itertools
import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanload.llm.common import batches_of, stage
from spanload.llm.components import components

#: Vectors from which the rotation and the tree are fitted (any are right; fitted ones prune more).
FIT_ROWS = 2000
ALONE = -1  # the cell of a length that is one tile
LEAF = 8  # of these vectors below a node of the tree that isn't cut again
SQUARE = 512
MANY = 1 << 14  # pairs of a square that are computed all together
STAY = 1e5  # coordinates of a comparison that cost as much as a pair computed in full, in sorted tiles
GRAIN = 1 << 10  # of the whole numbers in which the tree measures: products are exact, so equal vectors stay together
TILE_BYTES = 1 << 20  # of a tile's vectors as float32
FILE_TILES, SIDE_TILES = 4, 32  # of a packed file; about so many tiles on a side of a task
CACHED = 40  # tiles that a worker holds made ready
FOUND = T.StructType([T.StructField("id", T.LongType()), T.StructField("links", T.LongType()),
                      T.StructField("root", T.LongType())])
TILES = T.StructType([T.StructField("dims", T.IntegerType()), T.StructField("alone", T.BooleanType()),
                      T.StructField("tile", T.LongType()),
                      T.StructField("ids", T.BinaryType()), T.StructField("copies", T.BinaryType()),
                      T.StructField("one", T.BinaryType()), T.StructField("two", T.BinaryType()),
                      T.StructField("vectors", T.BinaryType()), T.StructField("centre", T.ArrayType(T.DoubleType())),
                      T.StructField("radius", T.DoubleType())])


def usable(vector):
    """Not null, not zero, and all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)  # first by the largest: no overflow
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def fit_rotation(vectors: np.ndarray, dims: int) -> np.ndarray:
    """Principal axes of the sample, completed to a rotation; identity without a sample."""
    if len(vectors) < 2:
        return np.eye(dims)
    _, axes = np.linalg.eigh(np.cov(vectors, rowvar=False).reshape(dims, dims))
    return axes[:, ::-1]


def _margin(dims: int) -> float:
    """More than float32 products of so many coordinates of unit vectors are off."""
    return 1e-6 + 1.2e-7 * (dims + 2)


def leading(turned: np.ndarray, cosine: float, step: int) -> int:
    """How many coordinates to compare first: few, but few pairs shall stay, for one that stays
    costs as much as thousands of others.  Any number is right."""
    dims, x = turned.shape[1], turned[:500]
    off = ~np.eye(len(x), dtype=bool)
    product, rest, best = np.zeros((len(x), len(x))), np.ones(len(x)), (math.inf, dims)
    for k in range(step, dims, step):
        part = x[:, k - step: k]
        product += part @ part.T
        rest = np.maximum(0, rest - (part * part).sum(axis=1))
        stay = np.count_nonzero((product + np.sqrt(np.outer(rest, rest)) >= cosine)[off]) / max(1, off.sum())
        best = min(best, (k + STAY * stay, k))
    stay = np.count_nonzero((x @ x.T >= cosine)[off]) / max(1, off.sum())
    return min(best, (dims + STAY * stay, dims))[1]


class Tree:
    """Hyperplanes between far vectors of a sample; ``cells`` numbers the leaves from left to right.

    It measures in whole numbers whose float32 sums are exact, in any order: equal vectors
    are in one cell, whatever rows stand beside them.
    """

    def __init__(self, units: np.ndarray):
        whole = np.rint(units * GRAIN)
        self.axes: list[np.ndarray] = []
        self.cut: list[float] = []
        self.after: list[list[int]] = []  # of each node, left and right: a node, or -1 - cell
        self.leaves = 0
        open_ = [(np.arange(len(whole)), 0, -1, 0)]
        while open_:  # the left side first, so that cells are numbered in order
            own, depth, parent, side = open_.pop()
            x = whole[own]
            near = x[np.argmax(((x - x[:1]) ** 2).sum(axis=1))] if len(own) else None
            far = x[np.argmax(((x - near) ** 2).sum(axis=1))] if len(own) else None
            right = None
            if len(own) > LEAF and depth < 40 and (far != near).any():
                axis = np.rint(unit((far - near)[None])[0] * GRAIN)
                cut = float(np.floor((far + near) @ axis / 2)) + 0.5
                right = x @ axis > cut
            if right is None or right.all() or not right.any():
                node, self.leaves = -1 - self.leaves, self.leaves + 1
            else:
                node = len(self.cut)
                self.axes.append(axis)
                self.cut.append(cut)
                self.after.append([0, 0])
                open_ += [(own[right], depth + 1, node, 1), (own[~right], depth + 1, node, 0)]
            if parent >= 0:
                self.after[parent][side] = node

    def cells(self, units: np.ndarray) -> np.ndarray:
        if not self.cut:
            return np.zeros(len(units), np.int32)
        axes, cut, after = np.array(self.axes, np.float32), np.array(self.cut), np.array(self.after)
        right = np.rint(units * GRAIN).astype(np.float32) @ axes.T > cut
        node, live = np.zeros(len(units), int), np.arange(len(units))
        while len(live):
            node[live] = after[node[live], right[live, node[live]].astype(int)]
            live = live[node[live] >= 0]
        return (-1 - node).astype(np.int32)


class Model:
    """What is fitted for one length: the tree, and the leading axes of the rotation (None: all coordinates as they are)."""

    def __init__(self, sample: np.ndarray, cosine: float, step: int):
        units = unit(sample)
        dims = units.shape[1]
        self.tree = Tree(units)
        rotation = fit_rotation(units, dims)
        k = leading(units @ rotation, cosine, step)
        self.axes = np.ascontiguousarray(rotation[:, :k]) if k < dims else None


class Tile:
    """A packed row made ready: unit vectors, leading coordinates with the length of the rest, and balls of its squares."""

    def __init__(self, dims: int, ids: bytes, copies: bytes, vectors: bytes, model: Model | None):
        self.ids, self.copies = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
        kind = np.float32 if len(vectors) == 4 * dims * len(self.ids) else np.float64
        self.units = unit(np.frombuffer(vectors, kind).reshape(-1, dims))
        self.lead = self.units.astype(np.float32)
        if model is not None and model.axes is not None:
            turned = self.units @ model.axes
            rest = np.sqrt(np.maximum(0, 1 - (turned * turned).sum(axis=1)))
            self.lead = np.column_stack([turned, rest]).astype(np.float32)
        self.squares = [slice(a, a + SQUARE) for a in range(0, len(self.ids), SQUARE)]
        balls = [ball(self.units[s]) for s in self.squares]
        self.centres, self.radii = np.array([c for c, _ in balls]), np.array([r for _, r in balls])


def ball(units: np.ndarray) -> tuple[np.ndarray, float]:
    centre = units.mean(axis=0)
    return centre, float(np.sqrt(((units - centre) ** 2).sum(axis=1).max()))


class Links:
    """Link counts by tile, and links of which only a spanning forest is kept."""

    def __init__(self):
        self.counts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.limit = 0, 1 << 20

    def of(self, number: int, tile: Tile) -> np.ndarray:
        if number not in self.counts:
            self.counts[number] = tile.ids, np.zeros(len(tile.ids), np.int64)
        return self.counts[number][1]

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        self.pairs.append((a, b))
        self.held += len(a)
        if self.held > self.limit:
            ids, roots = self.forest()
            self.pairs, self.held = [(ids, roots)], len(ids)
            self.limit = max(self.limit, 2 * self.held)

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """Every id of a link, and the least that it reaches."""
        if not self.pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = (np.concatenate(x) for x in zip(*self.pairs, strict=True))
        ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        return ids, ids[_roots(len(ids), [(place[: len(a)], place[len(a):])])]

    def rows(self) -> Iterator[pa.RecordBatch]:
        ids, roots = self.forest()
        for own, counts in self.counts.values():
            some = np.flatnonzero(counts)
            if len(some):
                root = roots[np.searchsorted(ids, own[some])]
                yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array(counts[some]), pa.array(root)],
                                                 names=FOUND.names)


def _roots(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least place reachable over the links, for each place."""
    root = np.arange(n)
    changed = True
    while changed:
        changed = False
        for i, j in links:
            least = np.minimum(root[i], root[j])
            before = root.copy()
            np.minimum.at(root, i, least)
            np.minimum.at(root, j, least)
            root = root[root]
            changed = changed or not np.array_equal(before, root)
    return root


def compare_tiles(a: Tile, b: Tile, counts_a: np.ndarray, counts_b: np.ndarray, cosine: float, links: Links) -> None:
    """Adds the links between two tiles, or within one if ``b`` is ``a``."""
    reach = math.sqrt(2 * (1 - cosine))
    apart = np.sqrt(np.maximum(0, ((a.centres[:, None] - b.centres[None]) ** 2).sum(axis=2)))
    both = a.radii[:, None] + b.radii[None]
    margin = _margin(a.lead.shape[1])
    room = np.empty((SQUARE, SQUARE), np.float32)
    for p, s in enumerate(a.squares):
        for q, t in enumerate(b.squares):
            same = a is b and p == q
            if a is b and q < p or apart[p, q] > both[p, q] + reach + 1e-6:
                continue
            if apart[p, q] + both[p, q] < reach - 1e-6:
                _all(a, b, s, t, counts_a, counts_b, same, links)
                continue
            x, y = a.lead[s], b.lead[t]
            product = np.matmul(x, y.T, out=room.ravel()[: len(x) * len(y)].reshape(len(x), len(y)))
            if not same and product.max() < cosine - margin:
                continue
            stay = product >= cosine - margin
            if same:
                stay = np.triu(stay, 1)
            n = np.count_nonzero(stay)
            if n > MANY:
                _many(a, b, s, t, counts_a, counts_b, same, cosine, links)
            elif n:
                i, j = np.divmod(np.flatnonzero(stay), len(y))
                near = _near(a.units[s], b.units[t], i, j, cosine)
                i, j = i[near] + s.start, j[near] + t.start
                if len(i):
                    np.add.at(counts_a, i, b.copies[j])
                    np.add.at(counts_b, j, a.copies[i])
                    links.tie(a.ids[i], b.ids[j])


def _near(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
    """The rule itself, for pairs of rows."""
    out = np.zeros(len(i), bool)
    step = max(1, (1 << 20) // x.shape[1])
    for k in range(0, len(i), step):
        out[k: k + step] = (x[i[k: k + step]] * y[j[k: k + step]]).sum(axis=1) >= cosine
    return out


def _all(a, b, s, t, counts_a, counts_b, same, links) -> None:
    """Every pair of the square is a link."""
    if same:
        if len(a.ids[s]) > 1:
            counts_a[s] += a.copies[s].sum() - a.copies[s]
            links.tie(a.ids[s][1:], np.full(len(a.ids[s]) - 1, a.ids[s][0]))
        return
    counts_a[s] += b.copies[t].sum()
    counts_b[t] += a.copies[s].sum()
    links.tie(a.ids[s], np.full(len(a.ids[s]), b.ids[t][0]))
    links.tie(b.ids[t], np.full(len(b.ids[t]), a.ids[s][0]))


def _many(a, b, s, t, counts_a, counts_b, same, cosine, links) -> None:
    """A square of many links, of which as many as it has rows and columns are kept."""
    x, y = a.units[s], b.units[t]
    product = x @ y.T
    near = product >= cosine
    i, j = np.nonzero(np.abs(product - cosine) < 1e-9)  # the sums' order may tell
    near[i, j] = _near(x, y, i, j, cosine)
    if same:
        near = np.triu(near, 1)
    as_float = near.astype(np.float64)
    counts_a[s] += (as_float @ b.copies[t]).astype(np.int64)
    counts_b[t] += (a.copies[s] @ as_float).astype(np.int64)
    rows, columns = np.arange(len(x)), np.full(len(y), len(x))
    if same:
        near = near | near.T
        columns = rows.copy()
    while True:
        least = np.minimum(columns, np.where(near, rows[:, None], len(x)).min(axis=0))
        reached = np.minimum(rows, np.where(near, least[None], len(x)).min(axis=1))
        done = np.array_equal(least, columns) and np.array_equal(reached, rows)
        rows, columns = reached, least
        if done:
            break
    i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    links.tie(a.ids[s][i], a.ids[s][rows[i]])
    links.tie(b.ids[t][j], a.ids[s][columns[j]])


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def near_vectors(df: DataFrame, cosine: float = 0.9, vec: str = "vec_id", embedding: str = "embedding",
                 block_dims: int = 16, tile: int = 4096) -> DataFrame:
    """Rows ``vec_id, n_links, component_id, kept``, one for each row.

    ``n_links``: other rows of cosine >= ``cosine`` (0 < cosine < 1); ``component_id``: the
    least id reachable over links; ``kept``: the row's id is that one.  Vectors that are
    null, zero or hold null or non-finite components link with nothing and are kept; so do
    rows with a null id (their component is null).  Vectors of different lengths never
    link.  Repeated rows link with each other.  An empty table gives no rows; other columns
    are not looked at.  The leading coordinates come in steps of ``block_dims``; ``tile``: most
    vectors of a tile.
    """
    vector = F.col(f"`{embedding}`")
    if df.select(vector).schema[0].dataType != T.ArrayType(T.FloatType()):
        vector = vector.cast("array<double>")
    rows = df.select(F.col(f"`{vec}`").cast("long").alias("id"), vector.alias("vector"))
    good = usable(F.col("vector")) & F.col("id").isNotNull()
    models = _models(rows.where(good), cosine, block_dims, tile)
    tiles = _packed(rows.where(good), models, tile)
    found = _links(tiles, models, cosine)
    totals = found.groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    judged = (_classes(tiles).join(totals, "id", "left").join(labels, "id", "left")
              .select("one", "two", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
                      F.coalesce("component", "id").alias("_component")))
    component = F.when(F.col("id").isNotNull(), F.coalesce("_component", "id"))
    one, two = name_of(F.col("vector"))
    # a vector goes by 128 bits; rows that aren't good are spread by their id and find no name
    named = rows.select("id", F.when(good, one).otherwise(F.xxhash64("id")).alias("one"), F.when(good, two).alias("two"))
    return (named.join(judged, ["one", "two"], "left")
            .select(F.col("id").alias("vec_id"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"),
                    F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))


def name_of(vector):
    """128 bits, the same for equal vectors (0.0 and -0.0 are equal)."""
    return F.xxhash64(vector), F.xxhash64(F.lit(1), vector)


def rows_of(dims: int, tile: int) -> int:
    """Most vectors of a tile."""
    return max(1, min(tile, max(64, TILE_BYTES // (4 * dims))))


def _models(good: DataFrame, cosine: float, block_dims: int, tile: int):
    """Broadcast, by length: what is fitted for lengths of more rows than ``tile``, None for others of more than a tile holds.

    At most the number of rows / 64.  The vectors of any other length are one tile.
    """
    dims = F.size("vector")
    held = F.greatest(F.lit(1), F.least(F.lit(tile), F.greatest(F.lit(64), F.floor(F.lit(TILE_BYTES) / (4 * F.col("dims"))))))
    sizes = good.groupBy(dims.alias("dims")).agg(F.count("*").alias("n")).where(F.col("n") > held)
    models: dict[int, Model | None] = {}
    for r in sizes.orderBy("dims").collect():
        models[r["dims"]] = None
        if r["n"] > tile:
            sample = good.where(dims == r["dims"]).select("vector", F.xxhash64("id").alias("h")).orderBy("h").limit(FIT_ROWS)
            models[r["dims"]] = Model(np.array([x[0] for x in sample.select("vector").collect()], np.float64), cosine, block_dims)
    return good.sparkSession.sparkContext.broadcast(models)


def _packed(good: DataFrame, models, tile: int) -> DataFrame:
    """Classes of equal vectors, a row for each tile of them, staged."""
    spark = good.sparkSession
    one, two = name_of(F.col("vector"))
    classes = good.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")).select(
        F.size("vector").alias("dims"), "id", "copies", one.alias("one"), two.alias("two"), "vector")
    schema = T.StructType([*classes.schema, T.StructField("cell", T.IntegerType())])
    names = schema.names

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, out = batch.column(0).to_numpy(), np.full(batch.num_rows, ALONE, np.int32)
            for dims in set(lengths.tolist()) & models.value.keys():
                own = np.flatnonzero(lengths == dims)
                out[own] = 0
                if models.value[dims] is not None:
                    out[own] = models.value[dims].tree.cells(unit(_vectors(batch.column(5).take(pa.array(own)), dims)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            begin, size = 0, 0 if batch is None else batch.num_rows
            lengths = np.empty(0) if batch is None else batch.column(0).to_numpy()
            while begin < size or batch is None and held:
                dims = int(held[0].column(0)[0].as_py() if held else lengths[begin])
                most = rows_of(dims, tile) - sum(len(x) for x in held)
                other = np.flatnonzero(lengths[begin: begin + most] != dims)
                end = begin + int(other[0]) if len(other) else min(size, begin + most)
                if end > begin:
                    held.append(batch.slice(begin, end - begin))
                if end - begin == most or end < size or batch is None:
                    yield _tile_row(held, dims, dims not in models.value, number)
                    held, number = [], number + 1
                begin = end

    with batches_of(spark, 2048):
        # a length's classes lie together; near ones too, and so many that a file has a few tiles
        bytes_ = good.agg(F.sum(F.size("vector").cast("long"))).first()[0] or 0
        files = -(-4 * bytes_ // (FILE_TILES * TILE_BYTES)) or 1
        # a length that is one tile has one place, so that it isn't cut
        place = ["dims", "cell", F.when(F.col("cell") != ALONE, F.col("one"))]
        dealt = classes.mapInArrow(cells, schema).repartitionByRange(files, *place)
        return stage(dealt.sortWithinPartitions(*place).drop("cell").mapInArrow(pack, TILES), "vector-tiles")


def _tile_row(held: list[pa.RecordBatch], dims: int, alone: bool, number: int) -> pa.RecordBatch:
    packed = [np.concatenate([x.column(c).to_numpy() for x in held]).tobytes() for c in range(1, 5)]
    vectors = np.concatenate([_vectors(x.column(5), dims) for x in held])
    centre, radius = ball(unit(vectors))
    return pa.RecordBatch.from_arrays(
        [pa.array([dims], pa.int32()), pa.array([alone]), pa.array([number], pa.int64()), *[pa.array([x], pa.binary()) for x in packed],
         pa.array([vectors.tobytes()], pa.binary()), pa.array([centre], pa.list_(pa.float64())),
         pa.array([radius], pa.float64())], names=TILES.names)


def _classes(tiles: DataFrame) -> DataFrame:
    """Rows ``id, copies, one, two``, one for each class."""
    names = ["id", "copies", "one", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(c[i].as_py(), np.int64)) for c in batch.columns], names=names)

    return tiles.select("ids", "copies", "one", "two").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _links(tiles: DataFrame, models, cosine: float) -> DataFrame:
    """Link counts and forest edges among the vectors of each length, staged."""
    reach = math.sqrt(2 * (1 - cosine)) + 1e-6
    columns = ["dims", "tile", "ids", "copies", "vectors", "centre", "radius"]
    # a task has a part of the tiles on each side, and reads both from the shared folder
    many = tiles.where("not alone")
    sides = max(8, -(-many.count() // SIDE_TILES))
    a, b = (many.select(*[F.col(c).alias(f"{c}_{x}") for c in columns]).coalesce(sides) for x in "ab")
    apart = F.sqrt(F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    # of a pair's two orders one is taken, by turns, so that all tasks have work
    order = F.when(F.col("tile_a") == F.col("tile_b"), True).otherwise(
        (F.col("tile_a") < F.col("tile_b")) == (F.pmod(F.col("tile_a").bitwiseXOR(F.col("tile_b")), F.lit(2)) == 0))
    pairs = a.join(b.hint("shuffle_replicate_nl"), (F.col("dims_a") == F.col("dims_b")) & order
                   & (apart <= F.col("radius_a") + F.col("radius_b") + reach))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, ready = Links(), OrderedDict()

        def tile_of(number: int, dims: int, *packed) -> Tile:
            if number not in ready:
                ready[number] = Tile(dims, *[x.as_py() for x in packed], models.value.get(dims))
                if len(ready) > CACHED:
                    ready.popitem(last=False)
            ready.move_to_end(number)
            return ready[number]

        for batch in batches:
            dims, left, right = (batch.column(c).to_pylist() for c in range(3))
            for i in range(batch.num_rows):
                x = tile_of(left[i], dims[i], *[batch.column(c)[i] for c in (3, 4, 5)])
                y = tile_of(right[i], dims[i], *[batch.column(c)[i] for c in (6, 7, 8)])
                compare_tiles(x, y, links.of(left[i], x), links.of(right[i], y), cosine, links)
        yield from links.rows()

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dims, *packed = (c[i].as_py() for c in batch.columns)
                if len(packed[0]) > np.int64().itemsize:
                    links, one = Links(), Tile(dims, *packed, None)
                    counts = links.of(0, one)
                    compare_tiles(one, one, counts, counts, cosine, links)
                    yield from links.rows()

    with batches_of(tiles.sparkSession, 4):
        met = pairs.select("dims_a", "tile_a", "tile_b", *[f"{c}_{x}" for x in "ab" for c in ("ids", "copies", "vectors")])
        single = tiles.where("alone").select("dims", "ids", "copies", "vectors")
        return stage(met.mapInArrow(run, FOUND).unionAll(single.mapInArrow(within, FOUND)), "vector-links")
