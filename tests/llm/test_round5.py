"""Vectors by packed tiles: all links, and disk that follows the input."""

import math
import os

import numpy as np
import pytest

from spanload.llm import vector_dedup as vd


def crowd(n, dims, seed):
    """Two dense groups, one all of near copies and one a chain, and vectors apart."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims))
    v[: n // 4] = rng.normal(size=dims) + 0.01 * rng.normal(size=(n // 4, dims))
    v[n // 4: n // 2] = rng.normal(size=dims) + 0.33 * rng.normal(size=(n // 4, dims))
    return v[rng.permutation(n)]


def judged(ids, vectors, cosine):
    """Links, and the least id of each component, by all pairs."""
    units = vd.unit(vectors)
    near = np.array([(units * u).sum(axis=1) >= cosine for u in units])
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        least = np.minimum(label, np.where(near, label[None], label.max()).min(axis=1))
        if (least == label).all():
            return near.sum(axis=1), label
        label = least


def shuffled(spark):
    """Bytes of Spark's shuffle files."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = (os.path.join(top, f) for d in dirs for top, _, names in os.walk(str(d)) for f in names if f.startswith("shuffle_"))
    return sum(os.path.getsize(f) for f in files if os.path.exists(f))


@pytest.mark.parametrize("wide", [True, False])
def test_squares_of_every_kind_give_all_links(monkeypatch, wide):
    """Squares apart, squares of links only, many links computed together and few one by one."""
    monkeypatch.setattr(vd, "SQUARE", 16)
    monkeypatch.setattr(vd, "MANY", 40)
    v = crowd(240, 12, 4)
    v[17] = v[3]
    model = vd.Model(v, 0.9, 4)
    if not wide:
        model.axes = vd.fit_rotation(vd.unit(v), 12)[:, :4]
    cells = model.tree.cells(vd.unit(v))
    assert cells[17] == cells[3] and cells.max() + 1 <= model.tree.leaves
    order = np.argsort(cells, kind="stable")
    ids, copies = order * 3 + 1, 1 + order % 3
    made = [vd.Tile(12, ids[s].tobytes(), copies[s].tobytes(), v[order[s]].tobytes(), model)
            for s in (slice(0, 100), slice(100, 240))]
    links = vd.Links()
    links.limit = 50
    for i, j in ((0, 0), (1, 0), (1, 1)):
        vd.compare_tiles(made[i], made[j], links.of(i, made[i]), links.of(j, made[j]), 0.9, links)
    got = {r["id"]: (r["links"], r["root"]) for b in links.rows() for r in b.to_pylist()}
    units = vd.unit(v[order])
    near = np.array([(units * u).sum(axis=1) >= 0.9 for u in units]) & ~np.eye(240, dtype=bool)
    _, label = judged(ids, v[order], 0.9)
    assert got == {i: ((near[k] * copies).sum(), label[k]) for k, i in enumerate(ids) if near[k].any()}


def test_vectors_in_many_tiles_don_t_fill_the_disk(spark, monkeypatch):
    """Tiles are read again, not copied: the old way wrote each vector once for every tile that it met."""
    peak, stage = [], vd.stage

    def staged(df, name):
        out = stage(df, name)
        peak.append(shuffled(spark))  # before Spark happens to clear its files
        return out

    monkeypatch.setattr(vd, "stage", staged)
    n = 3000
    v = crowd(n, 16, 6)
    v[5] = 2 * v[9]  # equal but for their length
    rows = [(i, [float(x) for x in v[i]]) for i in range(n)]
    rows += [(n, [0.0, 1.0]), (n + 1, [-0.0, 1.0]), (n + 2, [0.0, 1.0]), (n + 3, None), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).cache()
    assert df.count() == len(rows)
    before = shuffled(spark)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vd.near_vectors(df, 0.9, tile=16).collect()}
    assert max(peak) - before < 20 * n * 16 * 4
    links, label = judged(range(n), np.array([r[1] for r in rows[:n]], np.float32).astype(float), 0.9)
    assert links.max() > n // 8 and (links == 0).sum() > n // 8
    want = {i: (links[i], label[i], label[i] == i) for i in range(n)}
    want |= {n + k: (2, n, k == 0) for k in range(3)} | {n + 3: (0, n + 3, True), None: (0, None, True)}
    assert got == want


def test_whole_numbers_as_vectors(spark):
    df = spark.createDataFrame([(1, [3, 4]), (2, [30, 41]), (3, [4, -3])], "vec_id long, embedding array<int>")
    assert sorted(map(tuple, vd.near_vectors(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_leading_coordinates_never_hide_a_link():
    rng = np.random.default_rng(1)
    units = vd.unit(rng.normal(size=(300, 40)) * np.linspace(2, 0.1, 40))
    turned = units @ vd.fit_rotation(units, 40)
    for k in (1, 8, 39):
        rest = np.sqrt(np.maximum(0, 1 - (turned[:, :k] ** 2).sum(axis=1)))
        bound = turned[:, :k] @ turned[:, :k].T + np.outer(rest, rest)
        assert (bound >= units @ units.T - 1e-9).all()
    assert 1 <= vd.leading(turned, 0.9, 8) <= 40 and math.isclose(vd._margin(64), 1e-6 + 66 * 1.2e-7)


def test_lengths_of_one_tile_meet_no_other_tile(spark, monkeypatch):
    """Of 90 lengths two have more rows than a tile: only these are compared by pairs of tiles."""
    rng = np.random.default_rng(8)
    sizes = {d: 3 for d in range(2, 92)} | {20: 70, 40: 150}
    rows, want, i = [], {}, 0
    for d, n in sizes.items():
        v = rng.normal(size=(n, d))
        v[n // 2:] = v[0] + 0.01 * rng.normal(size=(n - n // 2, d))
        rows += [(i + k, [float(x) for x in v[k]]) for k in range(n)]
        links, label = judged(range(i, i + n), v, 0.9)
        want |= {i + k: (links[k], label[k]) for k in range(n)}
        i += n
    tiles = []
    stage = vd.stage
    monkeypatch.setattr(vd, "stage", lambda df, name: tiles.append((name, stage(df, name))) or tiles[-1][1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vd.near_vectors(df, 0.9, tile=64).collect()}
    assert got == want
    held = [(r.dims, r.alone) for r in dict(tiles)["vector-tiles"].select("dims", "alone").collect()]
    assert len([d for d, alone in held if alone]) == 88 and {d for d, alone in held if not alone} == {20, 40}


@pytest.mark.parametrize("rows", [[], [(1, None), (None, None), (2, [0.0, 0.0]), (2, [])]])
def test_tables_without_a_usable_vector(spark, rows):
    got = vd.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 0.9).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, 0, i, True) for i, _ in rows), key=str)


def test_rows_of_one_id_and_wide_vectors(spark):
    """Tiles hold fewer vectors where these are long; rows of one id share their links, as before."""
    rng = np.random.default_rng(9)
    v = rng.normal(size=(140, 3000))
    v[100:] = v[:40] * 3 + 0.01
    df = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(140)] + [(139, [float(x) for x in v[0]])],
                               "vec_id long, embedding array<float>")
    got = sorted(map(tuple, vd.near_vectors(df, 0.9).collect()))
    want = [(i, 1 if 1 <= i < 40 or i >= 100 else 0, i - 100 if i >= 100 else i, not i >= 100) for i in range(140)]
    want[0], want[100] = (0, 2, 0, True), (100, 2, 0, False)
    # the row (139, v[0]) is of class 0; 139's own vector is near 39 only
    assert got == sorted([*want, (139, 2, 0, False)])
