"""The silhouette's sides, tiles and squares."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallybasket.operators import comparison, metrics
from tallybasket.session import materialize


def side(x, g, w, size, first_block=0):
    """A side of two blocks."""
    half = len(x) // 2
    parts = [slice(0, half), slice(half, len(x))]
    return metrics._Side(
        pa.table({
            "block": pa.array([first_block, first_block + 1]),
            **{name: pa.array([v[p].ravel().tolist() for p in parts]) for name, v in (("x", x), ("g", g), ("size", size), ("w", w))},
        }),
        g.shape[1],
    )


def sides(n=700, clusters=5, seed=0, offset=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(2 * n, 3)) + offset
    x[n : n + 20] = x[:20] + 1e-9  # nearly equal points, on two sides
    g = np.column_stack([rng.integers(0, clusters, 2 * n), rng.integers(0, 2, 2 * n)])
    w = rng.integers(1, 4, 2 * n)
    size = np.column_stack([np.bincount(g[:, s], w)[g[:, s]] for s in (0, 1)])
    return [side(x[p], g[p], w[p], size[p], b) for p, b in ((slice(0, n), 0), (slice(n, None), 2))]


def rows(tables):
    found = pa.concat_tables(tables).to_pylist()
    return {(r["block"], r["pos"], r["s"], r["c"]): (r["w"], r["size"], r["d"], r["b"]) for r in found}


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose([v or 0.0 for v in a[k]], [v or 0.0 for v in b[k]], rtol=1e-9, atol=1e-12)


def test_many_small_sides_become_few(spark):
    """A side of ten points would send every point 200 times."""
    points = spark.range(2000).select(F.rand(1).alias("x"), F.rand(2).alias("y"), (F.col("id") % 3).alias("c"))
    points = materialize(points, "points")
    found = metrics._sides(points, ["c"], ["x", "y"], side_points=10, block_rows=5)
    for part in (found.rows, found.columns):
        assert part.select(F.sum(F.size("w"))).first()[0] <= 2000 * metrics.BUSY_SIDES


def test_a_square_gives_the_sums_of_both_sides(monkeypatch):
    """Every pair is looked at once, and gives what two looks give; few and many groups in a tile."""
    for clusters in (3, 150):
        row, column = sides(clusters=clusters)
        twice = rows([*metrics._directed(row, column), *metrics._directed(column, row)])
        looked, distances = [], metrics._distances

        def counted(x, wide, y, *rest):
            looked.append(len(x) * len(y))
            return distances(x, wide, y, *rest)

        monkeypatch.setattr(metrics, "_distances", counted)
        same(rows(metrics._mutual(row, column)), twice)
        monkeypatch.undo()
        assert sum(looked) == 700 * 700


def test_room_for_few_groups_at_a_time(monkeypatch):
    row, column = sides(clusters=40)
    whole = rows(metrics._mutual(row, column))
    monkeypatch.setattr(metrics, "KEPT_SUMS", 3 * len(column.w))
    seen, sums = [], metrics._Tiles.sums

    def watched(self, x, w, group, back):
        seen.append(back.shape[1])
        return sums(self, x, w, group, back)

    monkeypatch.setattr(metrics._Tiles, "sums", watched)
    same(rows(metrics._mutual(row, column)), whole)
    assert max(seen) <= 3


def test_distances_of_near_points_far_from_the_origin():
    row, column = sides(offset=1e6)
    tiles = metrics._Tiles(column)
    d = np.sqrt(((row.x[:, None] - column.x[None]) ** 2).sum(-1)) * column.w
    want = np.column_stack([d[:, column.group == g].sum(axis=1) for g in range(column.groups)])
    assert np.allclose(tiles.sums(row.x), want, rtol=1e-9)
    near = metrics._Tiles(side(*(v[:20] for v in (row.x + 1e-9, row.g * 0, row.w * 0 + 1, row.size))))
    assert np.allclose(near.sums(row.x[:20])[:, 0], np.sqrt(((row.x[:20, None] - row.x[None, :20] - 1e-9) ** 2).sum(-1)).sum(1), rtol=1e-9)


def test_infinite_values_go_by_differences():
    row, column = sides(n=40)
    column.x[3, 1] = np.inf
    assert np.isinf(metrics._Tiles(column).sums(row.x)[:, column.group[3]]).all()


def test_a_tile_stays_small():
    """Distances of 2,048 to 8,192 points never stand in memory at once."""
    row, column = sides(n=8192)
    tiles = metrics._Tiles(column)
    tracemalloc.start()
    tiles.sums(row.x[:2048])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6


def test_many_joint_groups_go_by_the_clusters_of_each_labelling():
    """Labellings that cross in more groups than they have clusters: the same sums, and no column for a group."""
    row, column = sides(clusters=40)
    assert row.groups > sum(row.widths)
    same(rows(metrics._by_cluster(row, column, both=True)), rows(metrics._mutual(row, column)))
    same(rows(metrics._by_cluster(row, row, both=False)), rows(metrics._directed(row, row)))


def test_silhouettes_of_labellings_that_cross(spark):
    """Five labellings of independent clusters: 300 points in nearly as many groups, 25 clusters."""
    rng = np.random.default_rng(3)
    x, g = rng.normal(size=(300, 2)), rng.integers(0, 5, size=(300, 5))
    names = [f"g{i}" for i in range(5)]
    values = [(*map(float, p), *map(int, q)) for p, q in zip(x, g)]
    points = spark.createDataFrame(values, "x double, y double, " + ", ".join(f"{n} int" for n in names))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    got = {r["labelling"]: r["silhouette"] for r in metrics.silhouettes(points, names, ["x", "y"]).collect()}
    for s, name in enumerate(names):
        mean = np.column_stack([d[:, g[:, s] == c].sum(1) for c in range(5)])
        n = np.bincount(g[:, s], minlength=5)
        own = np.arange(5) == g[:, s, None]
        a, b = (mean * own).sum(1) / (n[g[:, s]] - 1), np.where(own, np.inf, mean / n).min(1)
        assert np.isclose(got[name], ((b - a) / np.maximum(a, b)).mean(), rtol=1e-9)


def brute(x, g, w):
    """Silhouette of weighted points, those without a label left out."""
    x, g = (np.repeat(np.asarray(v), w, axis=0)[np.repeat(g, w) >= 0] for v in (x, g))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    ids, of = np.unique(g, return_inverse=True)
    total, n = np.column_stack([d[:, of == c].sum(1) for c in range(len(ids))]), np.bincount(of)
    own = np.arange(len(ids)) == of[:, None]
    a, b = (total * own).sum(1) / np.maximum(n[of] - 1, 1), np.where(own, np.inf, total / n).min(1)
    return np.where(n[of] == 1, 0.0, (b - a) / np.maximum(a, b)).mean()


def test_rows_without_a_label_take_no_part_in_that_labelling(spark):
    """Two labellings of weighted points, each without labels elsewhere; points without any label count nowhere."""
    rng = np.random.default_rng(5)
    x, w = rng.normal(size=(600, 2)), rng.integers(1, 4, 600)
    g = np.column_stack([rng.integers(-1, 3, 600), rng.integers(-1, 40, 600)])
    values = [(*map(float, p), *(int(c) if c >= 0 else None for c in q), int(n)) for p, q, n in zip(x, g, w)]
    points = spark.createDataFrame(values, "x double, y double, g0 int, g1 int, w int")
    for labels in (["g0", "g1"], ["g1", "g0"], ["g0"]):
        got = {r["labelling"]: r for r in metrics.silhouettes(points, labels, ["x", "y"], 150, 16, weight="w").collect()}
        for name in labels:
            own = g[:, int(name[1:])]
            assert np.isclose(got[name]["silhouette"], brute(x, own, w), rtol=1e-9) and got[name]["n"] == w[own >= 0].sum()


def test_a_side_that_meets_itself_looks_at_half_of_the_pairs(monkeypatch):
    for clusters in (3, 40):
        row, _ = sides(n=2600, clusters=clusters)
        twice = rows(metrics._directed(row, row))
        looked, distances = [], metrics._distances

        def counted(x, *rest):
            looked.append(len(x) * len(rest[1]))
            return distances(x, *rest)

        monkeypatch.setattr(metrics, "_distances", counted)
        same(rows(metrics._mutual(row, row)), twice)
        assert sum(looked) < 0.6 * 2600**2
        monkeypatch.setattr(metrics, "KEPT_SUMS", 3 * len(row.w))
        same(rows(metrics._mutual(row, row)), twice)
        monkeypatch.undo()
        same(rows(metrics._by_cluster(row, row, both=True)), twice)


def test_compared_algorithms_share_one_look_at_the_pairs(spark, monkeypatch):
    """Labels of equal points that differ, rows left out and repeated: the silhouettes of each algorithm alone, from one pass."""
    rng = np.random.default_rng(7)
    x = np.repeat(rng.normal(size=(60, 2)), 2, axis=0)
    matrix = materialize(spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "CustomerID long, x double, y double"), "matrix")
    runs = {
        "halves": lambda m, cols, k: m.withColumn("Cluster", (F.col("x") > 0).cast("int")),
        "by id": lambda m, cols, k: m.withColumn("Cluster", (F.col("CustomerID") % 3).cast("int") - 1),
        "some": lambda m, cols, k: m.where("CustomerID < 50").unionByName(m.where("CustomerID < 9")).withColumn("Cluster", (F.col("CustomerID") % 7).cast("int")),
        "fails": lambda m, cols, k: m.select("nothing"),
        "one": lambda m, cols, k: m.withColumn("Cluster", F.lit(0)),
    }
    asked, silhouettes = [], metrics.silhouettes

    def watched(points, labels, *rest, **more):
        asked.append(len(labels))
        return silhouettes(points, labels, *rest, **more)

    monkeypatch.setattr(metrics, "silhouettes", watched)
    scores, labels = comparison.compare(matrix, ["x", "y"], 4, runs)
    got = {r["algorithm"]: r for r in scores.collect()}
    assert asked == [3]
    i = np.arange(120)
    once = np.ones(120, int)
    assert np.isclose(got["halves"]["silhouette"], brute(x, (x[:, 0] > 0).astype(int), once), rtol=1e-9)
    assert np.isclose(got["by id"]["silhouette"], brute(x, i % 3 - 1, once), rtol=1e-9)
    assert np.isclose(got["some"]["silhouette"], brute(x, np.where(i < 50, i % 7, -1), 1 + (i < 9)), rtol=1e-9)
    assert got["fails"]["error"] and got["fails"]["n_clusters"] is None and tuple(got["one"])[1:] == (1, None, None)
    assert labels.groupBy("algorithm").count().count() == 4


def test_enough_sides_for_the_sums_of_many_clusters(spark, monkeypatch):
    """Where a square of few sides has no room for the sums of both, more sides are made."""
    points = spark.range(4000).select(F.rand(1).alias("x"), F.rand(2).alias("y"), (F.col("id") % 200).alias("c"), (F.col("id") % 3).alias("few"))
    points = materialize(points, "points")
    monkeypatch.setattr(metrics, "SENT", 1)
    assert metrics._sides(points, ["few"], ["x", "y"], metrics.SIDE_POINTS, 64).n < 10
    monkeypatch.setattr(metrics, "KEPT_SUMS", 4000 // 10 * 200 // 10)
    assert metrics._sides(points, ["c"], ["x", "y"], metrics.SIDE_POINTS, 64).n >= 10
