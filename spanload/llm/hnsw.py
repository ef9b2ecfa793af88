"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Rows are dealt into shards of bounded size by a hash of their id.  In a shard equal
vectors are put together, levels are drawn from the vector's place in a fixed order, and
the graph of each level is kept as one flat array of neighbour places.  Points are put in
and looked up in batches: all searches of a batch take their steps together, as array
operations.  Largest inner product becomes least distance by one more coordinate, which
fills every vector up to the shard's longest.

The index (a row for each shard) is written to the shared folder.  Queries go to every
shard in chunks; each shard returns its best, which are merged.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanload.llm.common import stage
from spanload.llm.vector_dedup import usable

LINKS = 14  # of a node on a level; twice as many on the lowest
BUILD_WIDTH = 56  # kept while putting a point in
SEARCH_WIDTH = 128  # kept while searching the lowest level
SPREAD = 1 / np.log(LINKS)
BATCH = 512

INDEX = T.StructType([T.StructField("dims", T.IntegerType()), T.StructField("shard", T.IntegerType()),
                      *(T.StructField(c, T.BinaryType()) for c in
                        ("vectors", "members", "ends", "sizes", "neighbours"))])
FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                      T.StructField("score", T.DoubleType())])


class Graph(NamedTuple):
    vectors: np.ndarray  # float64, original
    filled: np.ndarray  # float32, one coordinate more
    levels: list[np.ndarray]  # from the lowest; the first so many nodes, each with places of neighbours, -1 none


def fill_up(vectors: np.ndarray) -> np.ndarray:
    squares = (vectors * vectors).sum(axis=1)
    rest = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
    out = np.column_stack([vectors, rest])
    return (out / (np.sqrt(squares.max(initial=0)) or 1)).astype(np.float32)


def _walk(level: np.ndarray, filled: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int,
          at_once: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``width`` places on a level for each query, best first, and their products."""
    n, q = len(level), len(queries)
    rows = np.arange(q)[:, None]
    seen = np.zeros((q, n + 1), bool)  # the last column stands for "none"
    seen[:, n] = True
    places = np.full((q, width), n)
    scores = np.full((q, width), -np.inf, np.float32)
    open_ = np.zeros((q, width), bool)
    places[:, 0] = entry
    scores[:, 0] = np.einsum("qd,qd->q", filled[entry], queries)
    open_[:, 0] = True
    seen[rows[:, 0], entry] = True
    live = np.arange(q)
    while len(live):
        p, s, o = places[live], scores[live], open_[live]
        r = rows[: len(live)]
        best = np.argsort(-np.where(o, s, -np.inf), axis=1)[:, :at_once]  # open ones first
        chosen = np.where(o[r, best], p[r, best], n)
        o[r, best] = False
        near = np.where(chosen[:, :, None] < n, level[np.minimum(chosen, n - 1)], -1).reshape(len(live), -1)
        near = np.where(near < 0, n, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near[seen[live[:, None], near]] = n
        seen[live[:, None], near] = True
        value = np.einsum("qkd,qd->qk", filled[np.minimum(near, n - 1)], queries[live])
        value[near == n] = -np.inf
        p, s = np.concatenate([p, near], 1), np.concatenate([s, value], 1)
        o = np.concatenate([o, near < n], 1)
        keep = np.argpartition(-s, width - 1, axis=1)[:, :width]
        p, s, o = p[r, keep], s[r, keep], o[r, keep]
        o &= s > -np.inf
        places[live], scores[live], open_[live] = p, s, o
        live = live[o.any(axis=1)]
    order = np.argsort(-scores, axis=1, kind="stable")
    return places[rows, order], scores[rows, order]


def _choose(filled: np.ndarray, base: np.ndarray, places: np.ndarray, links: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1 none) those not nearer to one already
    chosen than to the base; places left are filled with the nearest of the rest."""
    none = places < 0
    c = filled[np.maximum(places, 0)]
    to_base = 2 - 2 * np.einsum("bcd,bd->bc", c, filled[base])
    to_each = 2 - 2 * (c @ c.transpose(0, 2, 1))
    chosen = np.zeros(places.shape, bool)
    count = np.zeros(len(places), int)
    for k in range(places.shape[1]):
        blocked = (chosen & (to_each[:, k] < to_base[:, k, None])).any(axis=1)
        take = ~none[:, k] & ~blocked & (count < links)
        chosen[:, k] = take
        count += take
    rank = np.where(chosen, 0, np.where(none, 2, 1)) * places.shape[1] + np.arange(places.shape[1])
    order = np.argsort(rank, axis=1)[:, :links]
    out = np.take_along_axis(places, order, 1)
    if out.shape[1] < links:
        out = np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)
    return out


def _descend(levels: list[np.ndarray], filled: np.ndarray, queries: np.ndarray, down_to: int) -> np.ndarray:
    """An entry for each query on the level below the last one walked."""
    entry = np.zeros(len(queries), int)
    for level in reversed(levels[down_to:]):
        entry = _walk(level, filled, queries, entry, 4, 1)[0][:, 0]
    return entry


def _put_in(filled: np.ndarray, n: int, links: int, above: list[np.ndarray]) -> np.ndarray:
    """The graph of the first n nodes on one level; the levels above are there already."""
    level = np.full((n, links), -1, np.int32)
    upper = len(above[0]) if above else 0
    done = min(n, links + 1)
    for i in range(done):  # the first ones all know each other
        others = np.array([j for j in range(done) if j != i][:links], np.int32)
        level[i, : len(others)] = others
    while done < n:
        end = min(n, done + min(BATCH, done))
        if done < upper < end:
            end = upper
        new = np.arange(done, end)
        queries = filled[new]
        entry = _descend(above, filled, queries, 0) if done >= upper > 0 else np.zeros(len(new), int)
        places, scores = _walk(level[:done], filled, queries, entry, BUILD_WIDTH, 3)
        places = np.where(np.isneginf(scores), -1, places)
        among = queries @ queries.T  # points of one batch meet each other, too
        np.fill_diagonal(among, -np.inf)
        k = min(links, len(new) - 1)
        if k > 0:
            nearest = np.argpartition(-among, k - 1, axis=1)[:, :k]
            places = np.concatenate([places, new[nearest]], 1)
            scores = np.concatenate([scores, np.take_along_axis(among, nearest, 1)], 1)
            order = np.argsort(-scores, axis=1, kind="stable")
            places = np.take_along_axis(places, order, 1)
        level[new] = _choose(filled, new, places[:, :BUILD_WIDTH], links)
        source = np.repeat(new, links)
        target = level[new].reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        _link_back(level, filled, source, target, links)
        done = end
    return level


def _link_back(level: np.ndarray, filled: np.ndarray, source: np.ndarray, target: np.ndarray, links: int) -> None:
    """Tie each target to its sources; where there are too many, the choice is made anew."""
    nearness = np.einsum("ed,ed->e", filled[source], filled[target])
    order = np.lexsort((-nearness, target))
    source, target = source[order], target[order]
    nodes, starts, counts = np.unique(target, return_index=True, return_counts=True)
    more = np.full((len(nodes), links), -1)
    place = np.arange(len(target)) - np.repeat(starts, counts)
    fits = place < links  # the nearest ones of this batch
    more[np.repeat(np.arange(len(nodes)), counts)[fits], place[fits]] = source[fits]
    for a in range(0, len(nodes), 1024):
        own = nodes[a: a + 1024]
        both = np.concatenate([level[own], more[a: a + 1024]], 1)
        both.sort(axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        value = np.einsum("bcd,bd->bc", filled[np.maximum(both, 0)], filled[own])
        value[both < 0] = -np.inf
        both = np.take_along_axis(both, np.argsort(-value, axis=1, kind="stable"), 1)
        level[own] = _choose(filled, own, both, links)


def build(vectors: np.ndarray, seed: int) -> Graph:
    """``vectors``: float64, in an order that has nothing to do with their values."""
    filled = fill_up(vectors)
    n = len(vectors)
    draw = np.random.Generator(np.random.PCG64(seed)).random(n)
    height = np.sort((-np.log(1 - draw) * SPREAD).astype(int))[::-1]  # places are in random order already
    levels: list[np.ndarray] = []
    for h in range(int(height[0]) if n else -1, -1, -1):
        size = int((height >= h).sum())
        levels.insert(0, _put_in(filled, size, 2 * LINKS if h == 0 else LINKS, levels))
    return Graph(vectors, filled, levels)


def search(graph: Graph, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k best for each query (-1 none) and exact products, best first."""
    n, top = len(graph.vectors), max(SEARCH_WIDTH, 2 * k)
    out_p, out_s = [], []
    for a in range(0, len(queries), BATCH):
        q = queries[a: a + BATCH]
        long = np.sqrt((q * q).sum(axis=1, keepdims=True))
        short = np.column_stack([q / long, np.zeros(len(q))]).astype(np.float32)
        entry = _descend(graph.levels, graph.filled, short, 1)
        places, scores = _walk(graph.levels[0], graph.filled, short, entry, top, 4)
        places = np.where(np.isneginf(scores), n, places)[:, : k + 16]
        held = graph.vectors[np.minimum(places, n - 1)]
        exact = np.zeros(places.shape)
        for d in range(q.shape[1]):  # one after the other, as plain SQL would add them
            exact += held[:, :, d] * q[:, None, d]
        exact[places == n] = -np.inf
        order = np.argsort(-exact, axis=1, kind="stable")[:, :k]
        out_p.append(np.where(np.isneginf(np.take_along_axis(exact, order, 1)), -1, np.take_along_axis(places, order, 1)))
        out_s.append(np.take_along_axis(exact, order, 1))
    return np.concatenate(out_p), np.concatenate(out_s)


def index_shard(pdf: pd.DataFrame, keep: int) -> pd.DataFrame:
    """One row: the shard's distinct vectors, the least ``keep`` ids of each, and the graph."""
    dims, shard = int(pdf["dims"].iloc[0]), int(pdf["shard"].iloc[0])
    ids = pdf["id"].to_numpy(np.int64)
    vectors = np.stack(pdf["vector"].to_numpy()).astype(np.float64) + 0.0
    kinds = np.unique(vectors.view(np.dtype((np.void, vectors.dtype.itemsize * dims))).ravel(), return_inverse=True)[1]
    order = np.lexsort((ids, kinds))
    starts = np.flatnonzero(np.diff(kinds[order], prepend=-1))
    groups = [np.unique(g)[:keep] for g in np.split(ids[order], starts[1:])]
    mixed = np.random.Generator(np.random.PCG64(shard)).permutation(len(groups))
    groups = [groups[i] for i in mixed]
    graph = build(vectors[order[starts]][mixed], shard)
    return pd.DataFrame([{
        "dims": dims, "shard": shard, "vectors": graph.vectors.tobytes(),
        "members": np.concatenate(groups).tobytes(),
        "ends": np.cumsum([len(g) for g in groups]).astype(np.int64).tobytes(),
        "sizes": np.array([x.shape for x in graph.levels], np.int64).tobytes(),
        "neighbours": b"".join(x.astype(np.int32).tobytes() for x in graph.levels)}])


def load_shard(row) -> tuple[Graph, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"]).reshape(-1, int(row["dims"]))
    levels, flat, at = [], np.frombuffer(row["neighbours"], np.int32), 0
    for n, links in np.frombuffer(row["sizes"], np.int64).reshape(-1, 2):
        levels.append(flat[at: at + n * links].reshape(n, links))
        at += n * links
    return (Graph(vectors, fill_up(vectors), levels), np.frombuffer(row["members"], np.int64),
            np.frombuffer(row["ends"], np.int64))


def search_shard(index: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The shard's best k for each query, never the query itself; ties to the lesser id."""
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                          "score": pd.Series(dtype="float64")})
    if index.empty or queries.empty:
        return empty
    graph, members, ends = load_shard(index.iloc[0])
    ids = queries["id"].to_numpy(np.int64)
    places, scores = search(graph, np.stack(queries["vector"].to_numpy()).astype(np.float64), k + 1)
    starts = np.concatenate([[0], ends[:-1]])
    out = []
    for q, ps, ss in zip(ids, places, scores, strict=True):
        rows = [(-s, m) for p, s in zip(ps, ss, strict=True) if p >= 0 for m in members[starts[p]: ends[p]] if m != q]
        out += [(q, m, -s) for s, m in sorted(rows)[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else empty


def build_index(df: DataFrame, k: int, vec: str = "vec_id", embedding: str = "embedding",
                shard_rows: int = 8192) -> DataFrame:
    """One row a shard, staged; every usable row with an id is in it."""
    rows = _usable_rows(df, vec, embedding)
    counts = {r["dims"]: r["n"] for r in rows.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    shards = F.lit(1)
    for dims, n in counts.items():
        shards = F.when(F.col("dims") == dims, F.lit(-(-n // shard_rows))).otherwise(shards)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), shards).cast("int"))
    return stage(dealt.groupBy("dims", "shard").applyInPandas(lambda pdf: index_shard(pdf, k + 1), INDEX), "hnsw")


def _usable_rows(df: DataFrame, vec: str, embedding: str) -> DataFrame:
    return (df.select(F.col(f"`{vec}`").cast("long").alias("id"), F.col(f"`{embedding}`").alias("vector"))
            .where(F.col("id").isNotNull() & usable(F.col("vector")))
            .withColumn("dims", F.size("vector")))


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, vec: str = "vec_id", embedding: str = "embedding",
            shard_rows: int = 8192, chunk_rows: int = 4096) -> DataFrame:
    """Rows ``query_id, rank, vec_id, score``: each query's k nearest by inner product.

    All rows of ``df`` but those with the query's id are candidates; with fewer than k, all
    are returned.  Vectors that are null, zero or hold null or non-finite components and
    rows with a null id take no part on either side; vectors of other lengths don't meet.
    Equal scores are in order of id.  Repeated rows of one id count once.  Empty tables
    give no rows; other columns are not looked at.
    """
    index = build_index(df, k, vec, embedding, shard_rows)
    asked = _usable_rows(queries, vec, embedding).dropDuplicates(["id"])
    chunks = max(1, -(-asked.count() // chunk_rows))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))
    places = index.groupBy("dims").agg(F.count("*").cast("int").alias("n"))
    to_all = asked.join(places, "dims").select("id", "vector", "dims", "chunk",
                                               F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("shard"))
    shards = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    keys = ["dims", "shard", "chunk"]
    found = shards.groupBy(*keys).cogroup(to_all.groupBy(*keys)).applyInPandas(
        lambda i, q: search_shard(i, q, k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
