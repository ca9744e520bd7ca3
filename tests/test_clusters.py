import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybasket.operators import comparison, dbscan, kmeans, lloyd, metrics, ward
from tallybasket.operators.components import connected_components

COLS = ["a", "b", "c"]


def frame(spark, x, label=None):
    label = np.zeros(len(x), dtype=int) if label is None else label
    rows = [(i, *map(float, v), int(g)) for i, (v, g) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "CustomerID long, a double, b double, c double, label int")


def blobs(seed=0, n=60):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0, 0], [6, 0, 0], [0, 6, 1]])
    label = rng.integers(0, 3, n)
    return centres[label] + rng.normal(scale=0.8, size=(n, 3)), label


def distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


def brute_silhouette(x, label):
    d, out = distances(x), []
    for i in range(len(x)):
        own = (label == label[i]) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, label == g].mean() for g in set(label) if g != label[i])
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


def brute_dbscan(x, eps, min_samples):
    near = distances(x) <= eps
    core = near.sum(1) >= min_samples
    label, current = np.full(len(x), -1), 0
    for i in range(len(x)):
        if label[i] != -1 or not core[i]:
            continue
        stack = [i]
        label[i] = current
        while stack:
            p = stack.pop()
            if core[p]:
                for q in np.flatnonzero(near[p] & (label == -1)):
                    label[q] = current
                    stack.append(q)
        current += 1
    return label


@pytest.mark.parametrize(("side_points", "block_rows"), [(20, 7), (1000, 1000)])
def test_silhouette_in_blocks_with_copies_and_a_singleton(spark, side_points, block_rows):
    x, label = blobs()
    x = np.vstack([x, np.repeat(x[:1], 30, axis=0), [[40.0, 40.0, 40.0]]])
    label = np.concatenate([label, np.repeat(label[:1], 30), [7]])
    other = (x[:, 0] > 1).astype(int)
    df = frame(spark, x, label).withColumn("other", (F.col("a") > 1).cast("int"))
    got = {r["labelling"]: r for r in metrics.silhouettes(df, ["label", "other"], COLS, side_points, block_rows).collect()}
    assert np.isclose(got["label"]["silhouette"], brute_silhouette(x, label))
    assert np.isclose(got["other"]["silhouette"], brute_silhouette(x, other))
    assert (got["label"]["n_clusters"], got["label"]["n"]) == (4, len(x))


def test_squared_silhouette_with_copies_and_a_singleton(spark):
    x, label = blobs(11, n=50)
    x, label = np.vstack([x, x[:5], [[40.0, 40.0, 40.0]]]), np.concatenate([label, label[:5], [7]])
    d, want = distances(x) ** 2, []
    for i in range(len(x)):
        own = (label == label[i]) & (np.arange(len(x)) != i)
        a, b = d[i, own].mean() if own.any() else 0, min(d[i, label == g].mean() for g in set(label) if g != label[i])
        want.append((b - a) / max(a, b) if own.any() else 0.0)
    got = metrics.squared_silhouettes(frame(spark, x, label), ["label"], COLS).first()
    assert np.isclose(got["squared_silhouette"], np.mean(want)) and (got["n_clusters"], got["n"]) == (4, len(x))
    assert metrics.squared_silhouettes(frame(spark, x), ["label"], COLS).first()["squared_silhouette"] is None


def test_silhouette_needs_two_clusters(spark):
    x, _ = blobs(n=10)
    assert metrics.silhouettes(frame(spark, x), ["label"], COLS).first()["silhouette"] is None


def test_other_measures(spark):
    x, label = blobs(1)
    df, groups = frame(spark, x, label), sorted(set(label))
    centres = np.array([x[label == g].mean(0) for g in groups])
    spread = np.array([np.linalg.norm(x[label == g] - c, axis=1).mean() for g, c in zip(groups, centres)])
    worst = [
        max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(3) if j != i) for i in range(3)
    ]
    within = sum(((x[label == g] - c) ** 2).sum() for g, c in zip(groups, centres))
    between = sum((label == g).sum() * ((c - x.mean(0)) ** 2).sum() for g, c in zip(groups, centres))
    assert np.isclose(metrics.inertia(df, "label", COLS).first()[0], within)
    assert np.isclose(metrics.davies_bouldin(df, "label", COLS).first()[0], np.mean(worst))
    assert np.isclose(metrics.calinski_harabasz(df, "label", COLS).first()[0], (between / 2) / (within / (len(x) - 3)))


def test_elbow_and_best_silhouette(spark):
    rows = list(zip(range(2, 7), [100.0, 60.0, 40.0, 35.0, 33.0], [0.4, 0.6, 0.6, 0.2, 0.1]))
    sweep = spark.createDataFrame(rows, "k int, inertia double, silhouette double")
    assert metrics.elbow(sweep).first()["elbow_k"] == 4
    assert metrics.best_silhouette(sweep).first()["best_silhouette_k"] == 3
    steep = spark.createDataFrame([(2, 100.0), (3, 90.0), (4, 70.0), (5, 40.0)], "k int, inertia double")
    assert metrics.elbow(steep).first()["elbow_k"] == 4


def test_kmeans_finds_separate_groups(spark):
    x, label = blobs(2)
    df = frame(spark, x, label)
    fit = kmeans.fit_kmeans(df, COLS, 3, restarts=4)
    found = kmeans.assign_clusters(df, COLS, fit.centres)
    pairs = {(r["label"], r["Cluster"]) for r in found.collect()}
    assert len(pairs) == 3
    total = found.agg(F.sum(F.col("Distance_to_Center") * F.col("Distance_to_Center"))).first()[0]
    centres = np.array([x[label == g].mean(0) for g in range(3)])
    best = sum(((x[label == g] - c) ** 2).sum() for g, c in enumerate(centres))
    assert np.isclose(fit.inertia, total) and np.isclose(total, best)


def lloyd_by_hand(x, centres, passes):
    for _ in range(passes):
        label = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        centres = np.array([x[label == g].mean(0) if (label == g).any() else c for g, c in enumerate(centres)])
    d2 = ((x[:, None] - centres[None]) ** 2).sum(-1)
    return centres, d2.min(1).sum(), np.bincount(d2.argmin(1), minlength=len(centres))


@pytest.mark.parametrize("block_rows", [1, 8, 64])
def test_batched_passes_equal_lloyd_by_hand(spark, monkeypatch, block_rows):
    """Fits of several k from given centres, one of them with a centre that no point is near, and copies of points."""
    monkeypatch.setattr(lloyd, "BLOCK_ROWS", block_rows)
    x, _ = blobs(7, n=150)
    x = np.vstack([x, np.repeat(x[:2], 40, axis=0)])
    blocks = lloyd.pack(frame(spark, x), COLS)
    begin = [x[:2].copy(), x[3:8].copy(), np.vstack([x[:3], [[90.0, 90, 90]]])]
    for passes in (0, 1, 5):
        runs, _ = lloyd.lloyd(blocks, begin, passes, 0.0)
        for run, centres in zip(runs, begin):
            want, cost, sizes = lloyd_by_hand(x, centres, passes)
            assert np.allclose(run.centres, want) and np.isclose(run.cost, cost) and run.sizes == sizes.tolist()


def test_fits_share_passes_and_drop_out(spark, monkeypatch):
    x, _ = blobs(8, n=200)
    blocks = lloyd.pack(frame(spark, x), COLS)
    running, one_pass = [], lloyd.sums_of
    monkeypatch.setattr(lloyd, "sums_of", lambda blocks, fits: (running.append(len(fits)), one_pass(blocks, fits))[1])
    begin = [x[[i, i + 50, i + 100]] for i in range(12)]
    runs, passes = lloyd.lloyd(blocks, begin, 300, 1e-9)
    assert passes == len(running) == max(r.iterations for r in runs) + 1
    assert running[0] == 12 and running == sorted(running, reverse=True) and sum(running) == sum(r.iterations + 1 for r in runs)


def test_whole_blocks_need_no_look_at_their_points(spark, monkeypatch):
    """Far groups of near points: every block lies at one centre, so no point is measured, and the sums are right."""
    rng = np.random.default_rng(1)
    x = np.repeat([[0.0, 0, 0], [50, 0, 0]], 500, axis=0) + rng.normal(scale=0.1, size=(1000, 3))
    x = np.concatenate([x[:500], x[500:]])
    rows, leaves = np.arange(len(x)), list(lloyd._leaves(x, np.arange(len(x))))
    assert sorted(np.concatenate(leaves).tolist()) == rows.tolist() and max(map(len, leaves)) <= lloyd.BLOCK_ROWS
    n = np.array([len(v) for v in leaves])
    mean = np.array([x[v].mean(0) for v in leaves])
    x = x[np.concatenate(leaves)]
    far = ((x - np.repeat(mean, n, axis=0)) ** 2).sum(1)
    at = np.cumsum(n) - n
    radius, square = np.sqrt(np.maximum.reduceat(far, at)), np.add.reduceat(far, at)
    measured, squares = [], lloyd._squares
    monkeypatch.setattr(lloyd, "_squares", lambda p, c: (measured.append(len(p)), squares(p, c))[1])
    centres = np.array([[0.0, 0, 0], [50, 0, 0]])
    sums = lloyd._fit_sums(centres, n, radius, square, mean, x)
    assert measured == [len(n)] and sums[:, 0].tolist() == [500, 500]
    assert np.isclose(sums[:, 1].sum(), ((x[:, None] - centres[None]) ** 2).sum(-1).min(1).sum())


def test_drawn_starts_do_not_depend_on_the_partitioning(spark):
    x, _ = blobs(9, n=300)
    df = frame(spark, x)
    fits = [kmeans.fit_kmeans(part, COLS, 3, restarts=3) for part in (df.repartition(2), df.repartition(7))]
    assert np.allclose(sorted(fits[0].centres), sorted(fits[1].centres)) and np.isclose(fits[0].inertia, fits[1].inertia)


def test_fit_of_no_rows_and_of_equal_rows(spark):
    assert kmeans.fit_kmeans(frame(spark, np.zeros((0, 3))), COLS, 3).centres == []
    fit = kmeans.fit_kmeans(frame(spark, np.ones((20, 3))), COLS, 3)
    assert fit.centres == [[1.0, 1.0, 1.0]] and fit.inertia == 0 and fit.sizes == [20]


def test_packs_of_clusters_do_not_change_davies_bouldin(spark, monkeypatch):
    rng = np.random.default_rng(3)
    df = frame(spark, rng.normal(size=(300, 3)), rng.integers(0, 40, 300))
    whole = metrics.measures(df, ["label"], COLS).first().asDict()
    monkeypatch.setattr(metrics, "PACK", 6)
    packed = metrics.measures(df, ["label"], COLS).first().asDict()
    assert whole.keys() == packed.keys() and np.isclose(whole["davies_bouldin"], packed["davies_bouldin"]) and whole["n_clusters"] == 40


def test_sweep_agrees_with_single_measures(spark):
    x, label = blobs(3, n=40)
    table = {r["k"]: r for r in kmeans.sweep(frame(spark, x, label), COLS, max_clusters=3, restarts=2).collect()}
    assert set(table) == {2, 3} and table[3]["inertia"] < table[2]["inertia"]
    assert np.isclose(table[3]["silhouette"], brute_silhouette(x, label))
    quick = kmeans.sweep(frame(spark, x, label), COLS, max_clusters=3, restarts=2, with_silhouette=False).collect()
    assert [r["silhouette"] for r in quick] == [None, None]
    assert np.allclose(sorted(r["inertia"] for r in quick), sorted(r["inertia"] for r in table.values()))


def test_pca_is_centred_and_signed(spark):
    x, _ = blobs(4)
    x = x + 10
    df = frame(spark, x)
    _, projection = kmeans.fit_pca(df, COLS, 2)
    got = np.array([[r["PCA1_2D"], r["PCA2_2D"]] for r in kmeans.project(df, projection).orderBy("CustomerID").collect()])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    vectors = vectors[:, ::-1][:, :2]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), [0, 1]])
    assert np.allclose(got, (x - x.mean(0)) @ vectors)
    assert np.isclose(sum(projection.explained), values[::-1][:2].sum() / values.sum())


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 90, 95, 100, 200]], "node long")
    got = {r["node"]: r["label"] for r in connected_components(nodes, spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (90, 95, 100)} == {90} and got[200] == 200


@pytest.mark.parametrize("seed", range(4))
def test_dbscan_against_brute_force(spark, seed, monkeypatch):
    """Scattered points, a dense spot with many copies, and salts small enough to matter."""
    monkeypatch.setattr(dbscan, "SALT_ROWS", 5)
    rng = np.random.default_rng(seed)
    dense = rng.normal(scale=0.1, size=(80, 3))
    x = np.vstack([rng.uniform(-2, 2, size=(120, 3)), dense, np.repeat(dense[:1], 40, axis=0), rng.normal([1.2, 0, 0], 0.15, (30, 3))])
    x = x[rng.permutation(len(x))].round(3)
    got = {r["CustomerID"]: r["Cluster"] for r in dbscan.dbscan(frame(spark, x), "CustomerID", COLS, 0.5, 5).collect()}
    assert [got[i] for i in range(len(x))] == brute_dbscan(x, 0.5, 5).tolist()


def test_border_point_joins_the_least_cluster(spark):
    left = [[-0.9 + 0.1 * i, 0, 0] for i in range(5)]
    right = [[0.5 + 0.1 * i, 0, 0] for i in range(5)]
    x = np.array([*right, *left, [0.0, 0.0, 0.0]])
    expected = brute_dbscan(x, 0.5, 5)
    got = {r["CustomerID"]: r["Cluster"] for r in dbscan.dbscan(frame(spark, x), "CustomerID", COLS, 0.5, 5).collect()}
    assert [got[i] for i in range(11)] == expected.tolist()


def brute_ward(x, n, k):
    """Heights of all merges, and the groups when k are left, by trying every pair."""
    groups, heights, cut = [([i], x[i], n[i]) for i in range(len(x))], [], None
    while True:
        if len(groups) == k:
            cut = {frozenset(g[0]) for g in groups}
        if len(groups) == 1:
            return heights, cut
        cost, i, j = min(
            (a[2] * b[2] / (a[2] + b[2]) * ((a[1] - b[1]) ** 2).sum(), i, j)
            for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j
        )
        a, b = groups[i], groups[j]
        heights.append(np.sqrt(2 * cost))
        groups = [g for h, g in enumerate(groups) if h not in (i, j)] + [(a[0] + b[0], (a[1] * a[2] + b[1] * b[2]) / (a[2] + b[2]), a[2] + b[2])]


@pytest.mark.parametrize("cells", [7, 1 << 20])
def test_ward_equals_brute_force_where_every_cell_is_a_point(spark, monkeypatch, cells):
    monkeypatch.setattr(ward, "CELLS", cells)
    x, _ = blobs(6, n=45)
    copies = np.array([1 + i % 3 for i in range(len(x))])
    df = frame(spark, np.repeat(x, copies, axis=0))
    heights, cut = brute_ward(x, copies, 4)
    tree = ward.dendrogram(df, COLS).orderBy("step").collect()
    assert np.allclose([r["height"] for r in tree], heights) and tree[-1]["points"] == copies.sum()
    assert all(max(r["left"], r["right"]) < len(x) + r["step"] for r in tree)
    found, groups = ward.ward(df, COLS, 4).orderBy("CustomerID").collect(), {}
    point = np.repeat(np.arange(len(x)), copies)
    for r in found:
        groups.setdefault(r["Cluster"], set()).add(int(point[r["CustomerID"]]))
    assert {frozenset(g) for g in groups.values()} == cut and sorted(groups) == [0, 1, 2, 3]


def test_ward_in_cells_keeps_all_points_and_far_groups(spark):
    rng = np.random.default_rng(4)
    label = rng.integers(0, 3, 3000)
    x = np.array([[0.0, 0, 0], [90, 0, 0], [0, 90, 5]])[label] + rng.normal(size=(3000, 3))
    placed = ward.with_cells(frame(spark, x, label), COLS, 100)
    assert 3 < placed.select("cell").distinct().count() <= 100
    found = ward.ward(frame(spark, x, label), COLS, 3, 100)
    assert found.count() == 3000 and found.select("label", "Cluster").distinct().count() == 3


def chained_ward(x):
    """Heights of Ward's hierarchy over single points, by a chain of nearest neighbours."""
    n, mean, alive, chain, heights = np.ones(len(x)), x.copy(), np.ones(len(x), bool), [], []
    while alive.sum() > 1:
        chain = chain or [int(np.flatnonzero(alive)[0])]
        a = chain[-1]
        cost = np.where(alive, n[a] * n / (n[a] + n) * ((mean - mean[a]) ** 2).sum(axis=1), np.inf)
        cost[a] = np.inf
        b = int(cost.argmin())
        if len(chain) < 2 or cost[chain[-2]] > cost[b]:
            chain.append(b)
            continue
        b = chain[-2]
        heights.append(np.sqrt(2 * cost[b]))
        mean[a], n[a], alive[b] = (mean[a] * n[a] + mean[b] * n[b]) / (n[a] + n[b]), n[a] + n[b], False
        del chain[-2:]
    return np.sort(heights)


def test_ward_takes_every_point_however_many(spark):
    rng = np.random.default_rng(8)
    x = np.exp(rng.normal(size=(4500, 3)))
    tree = ward.dendrogram(frame(spark, x), COLS).toPandas().sort_values("step")
    assert len(tree) == len(x) - 1 and tree["points"].iloc[-1] == len(x)
    assert np.allclose(tree["height"], chained_ward(x))
    # Three points far out take two of four clusters, and all others the rest.
    y = np.r_[x, x.max(axis=0) + [[1e6, 0, 0], [1e6, 1e-3, 0], [-1e6, 0, 0]]]
    found = comparison.hierarchical(frame(spark, y), COLS, 4).toPandas()
    ends = found.sort_values("CustomerID")["Cluster"].tolist()[-3:]
    assert ends[0] == ends[1] != ends[2] and found["Cluster"].nunique() == 4


def test_ward_refuses_points_without_a_place(spark):
    x = np.arange(12.0).reshape(4, 3)
    x[1, 1] = np.inf
    with pytest.raises(ValueError):
        ward.ward(frame(spark, x), COLS, 2)


def test_ward_of_few_points(spark):
    assert ward.ward(frame(spark, np.zeros((0, 3))), COLS, 3).count() == 0
    assert {r["Cluster"] for r in ward.ward(frame(spark, np.ones((5, 3))), COLS, 3).collect()} == {0}


def test_comparison_goes_on_after_an_error(spark):
    x, label = blobs(5)

    def broken(matrix, cols, k):
        raise RuntimeError("no such method")

    runs = {"Agglomerative": comparison.hierarchical, "Broken": broken, "DBSCAN": comparison.ALGORITHMS["DBSCAN"]}
    scores, labels = comparison.compare(frame(spark, x, label).drop("label"), COLS, 3, runs)
    rows = {r["algorithm"]: r for r in scores.collect()}
    assert rows["Broken"]["error"] == "no such method" and rows["Agglomerative"]["n_clusters"] == 3
    assert labels.where("algorithm = 'Agglomerative'").count() == len(x)
