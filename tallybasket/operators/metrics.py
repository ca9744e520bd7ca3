"""Measures of a clustering: inertia, Davies-Bouldin, Calinski-Harabasz, silhouette, elbow."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybasket.functions import columns as fx
from tallybasket.session import materialize, prepare_tasks

# The elbow's slow-down factor and the k it falls back to.
ELBOW_FACTOR = 0.7
ELBOW_DEFAULT = 4

#: Points per packed block of the silhouette, and cells (points times clusters) a task holds at a time.
BLOCK_ROWS = 2048
CELLS = 1 << 22
#: Distances computed at a time, as rows and columns: a tile that stays in a core's cache. The columns are a multiple of the rows.
TILE = (256, 256)
#: Points that a side of the silhouette holds, as long as that gives few sides. Beyond, the sides grow with the table
#: until they hold so many coordinates (16 MB): what is sent and what comes back grows with the number of sides.
SIDE_POINTS = 65_536
FEW_SIDES = 4
SIDE_VALUES = 1 << 21
#: Points of a side at least, and sides at most, where more sides are made for the sake of busy cores.
LEAST_ROWS = 256
BUSY_SIDES = 16
#: Pairs that a core looks at in the time that the sums of one point to one side take on their way.
SENT = 9_000
#: Sums that a task keeps for the points of its column while it goes through its row, and points of a group that make this worth while.
KEPT_SUMS = 1 << 24
WORTH_ROWS = 8
#: Groups of a tile up to which sums are a product with their members; beyond, sums over runs. Both are exact.
FEW_CLUSTERS = 16
#: Clusters of all labellings up to which sums go by clusters where the labellings' joint groups are more than these.
COLUMNS = 128
#: A squared distance below this share of the points' own squares is computed again from the differences.
CLOSE = 1e-7
#: Clusters compared in one row of the Davies-Bouldin index.
PACK = 256


def centroids(points: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each column per label, with the number of rows: ``label``, ``n``, ``c_<col>``."""
    return points.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"c_{c}") for c in cols])


def _stacked(points: DataFrame, labels: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Every point once for each labelling: the columns, ``_s`` (the labelling's number) and ``_c`` (the cluster)."""
    return points.select(*cols, F.posexplode(F.array(*[F.col(c).cast("long") for c in labels])).alias("_s", "_c"))


def cluster_spreads(points: DataFrame, labels: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per labelling and cluster: s, c, n, spread (mean distance to the centroid), within (sum of squares), c_<col>.

    Two passes over the points serve all labellings: one grouping for the centroids, which are written, and one for
    the distances to them.
    """
    stacked = _stacked(points, labels, cols)
    means = stacked.groupBy("_s", "_c").agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"c_{c}") for c in cols])
    means = materialize(means, "centroids")
    d2 = fx.squared_distance([F.col(c) for c in cols], [F.col(f"c_{c}") for c in cols])
    measured = stacked.join(means, ["_s", "_c"]).withColumn("_d2", d2)
    kept = [F.max(f"c_{c}").alias(f"c_{c}") for c in cols]
    grouped = measured.groupBy(F.col("_s").alias("s"), F.col("_c").alias("c"))
    return grouped.agg(F.max("_n").alias("n"), *kept, F.avg(F.sqrt("_d2")).alias("spread"), F.sum("_d2").alias("within"))


def _worst_ratios(clusters: DataFrame, cols: Sequence[str]) -> DataFrame:
    """s, davies_bouldin: mean over clusters of the worst (spread + spread) / distance between centroids.

    Clusters are packed, ``PACK`` to a row, and packs meet each other: no row holds all clusters, and no pair of clusters is a row.
    A cluster that is alone in its labelling has no ratio.
    """
    packs = clusters.groupBy("s").agg(F.ceil(F.count(F.lit(1)) / PACK).alias("packs"))
    one = F.struct("c", "spread", F.array(*[f"c_{c}" for c in cols]).alias("centre"))
    packed = clusters.join(packs, "s").groupBy("s", F.pmod(F.xxhash64("c"), F.col("packs")).alias("pack")).agg(F.collect_list(one).alias("own"))
    packed = materialize(packed, "cluster-packs")

    def gap(a, b):
        return F.sqrt(
            F.aggregate(F.zip_with(a["centre"], b["centre"], lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
        )

    def worst(a):
        others = F.filter("other", lambda b: b["c"] != a["c"])
        ratios = F.transform(others, lambda b: F.coalesce(F.try_divide(a["spread"] + b["spread"], gap(a, b)), F.lit(0.0)))
        return F.struct(a["c"].alias("c"), F.array_max(ratios).alias("ratio"))

    met = packed.join(packed.select("s", F.col("own").alias("other")), "s")
    ratios = met.select("s", F.explode(F.transform("own", worst)).alias("w")).groupBy("s", "w.c").agg(F.max("w.ratio").alias("ratio"))
    return ratios.groupBy("s").agg(F.avg("ratio").alias("davies_bouldin"))


def measures(points: DataFrame, labels: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per labelling: labelling, n_clusters, n, inertia, davies_bouldin, calinski_harabasz.

    Davies & Bouldin 1979; Calinski & Harabasz 1974, the between-cluster over the within-cluster variance, 1 where clusters have
    no extent and NULL for a single cluster.
    """
    clusters = materialize(cluster_spreads(points, labels, cols), "cluster-spreads")
    # The overall mean is the count-weighted mean of the centroids.
    overall = clusters.groupBy("s").agg(*[(F.sum(F.col("n") * F.col(f"c_{c}")) / F.sum("n")).alias(f"m_{c}") for c in cols])
    between = F.col("n") * fx.squared_distance([F.col(f"c_{c}") for c in cols], [F.col(f"m_{c}") for c in cols])
    sums = clusters.join(overall, "s").groupBy("s").agg(
        F.sum(between).alias("b"), F.sum("within").alias("w"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")
    )
    b, w, k, n = F.col("b"), F.col("w"), F.col("k"), F.col("n")
    score = fx.ratio(b * (n - k), w * (k - 1))
    return sums.join(_worst_ratios(clusters, cols), "s", "left").select(
        F.element_at(F.array(*[F.lit(c) for c in labels]), F.col("s") + 1).alias("labelling"),
        k.alias("n_clusters"),
        "n",
        w.alias("inertia"),
        "davies_bouldin",
        F.when(w == 0, F.lit(1.0)).otherwise(score).alias("calinski_harabasz"),
    )


def inertia(points: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Sum of squared distances to the own centre, as one row."""
    return cluster_spreads(points, [label], cols).agg(F.sum("within").alias("inertia"))


def davies_bouldin(points: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    return measures(points, [label], cols).select("davies_bouldin")


def calinski_harabasz(points: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    return measures(points, [label], cols).select("calinski_harabasz")


def silhouettes(
    points: DataFrame,
    labels: Sequence[str],
    cols: Sequence[str],
    side_points: int = SIDE_POINTS,
    block_rows: int = BLOCK_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Mean silhouette with Euclidean distances (Rousseeuw 1987) for one or more labellings.

    Gives one row per labelling: ``labelling``, ``n_clusters``, ``n``, ``silhouette``;
    NULL for fewer than two clusters. A point alone in its cluster counts 0. A row stands for ``weight`` equal points, or for one.
    A row without a label takes no part in that labelling, though ``n_clusters`` counts the missing label as one.

    Mean Euclidean distances need every pair of points. Equal points are merged first and weighted by their number. The rest
    is packed into blocks and dealt to sides; sides meet as rows and columns of a checkerboard, so a block is sent once
    for each side and not once for each other block. One distance serves both of its points and all labellings. A task folds the clusters
    that lie whole in a side into a least mean distance, and emits sums of those alone that go on in
    other sides; small clusters stand together in one side. The work stays quadratic in the distinct points; what is sent grows
    with the number of sides, which stays small until a side holds ``SIDE_VALUES`` coordinates.
    """
    prepare_tasks(points.sparkSession)
    sides = _sides(points, labels, cols, side_points, block_rows, weight)
    # All sums of a block meet in one task, so one exchange serves both groupings.
    sums = _distance_sums(sides, len(labels)).repartition("block")
    at, own = ["block", "pos", "s"], F.col("c").isNull()
    totals = sums.groupBy(*at, "c").agg(F.sum("d").alias("d"), F.min("b").alias("b"), F.max("size").alias("size"), F.max("w").alias("w"))
    found = totals.groupBy(*at).agg(
        F.max(F.when(own, F.col("d"))).alias("a"),
        F.min(F.when(own, F.col("b")).otherwise(F.col("d") / F.col("size"))).alias("b"),
        F.max(F.when(own, F.col("size"))).alias("size"),
        F.max(F.when(own, F.col("w"))).alias("w"),
    )
    a, b = F.try_divide(F.col("a"), (F.col("size") - 1).cast("double")), F.col("b")
    value = F.when(F.col("size") == 1, F.lit(0.0)).otherwise(F.coalesce(fx.ratio(b - a, F.greatest(a, b)), F.lit(0.0)))
    per_labelling = found.groupBy("s").agg(
        F.sum("w").alias("n"),
        (F.sum(F.when(b.isNotNull(), value * F.col("w"))) / F.sum("w")).alias("silhouette"),
    )
    per_labelling = materialize(per_labelling, "silhouettes")
    counts = sides.sizes.groupBy("s").agg(F.count(F.lit(1)).alias("n_clusters"))
    names = F.array(*[F.lit(c) for c in labels])
    return per_labelling.join(counts, "s").select(
        F.element_at(names, F.col("s") + 1).alias("labelling"), "n_clusters", "n", "silhouette"
    )


def squared_silhouettes(points: DataFrame, labels: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean silhouette with squared Euclidean distances: labelling, n_clusters, n, squared_silhouette.

    The mean squared distance to a cluster follows from its centroid and spread, so this measure takes passes in proportion
    to the table, where the Euclidean one takes every pair; its values are other ones. Meant for a number of clusters that
    fits in a row, as k-means has. NULL for fewer than two clusters; a point alone in its cluster counts 0.
    """
    clusters = cluster_spreads(points, labels, cols)
    one = F.struct("c", "n", (F.col("within") / F.col("n")).alias("v"), F.array(*[f"c_{c}" for c in cols]).alias("m"))
    packed = materialize(clusters.groupBy(F.col("s").alias("_s")).agg(F.collect_list(one).alias("_all")), "silhouette-clusters")
    x = [F.col(c) for c in cols]

    def mean_square(cluster):
        return fx.squared_distance(x, [cluster["m"][i] for i in range(len(cols))]) + cluster["v"]

    own = F.filter("_all", lambda k: k["c"] == F.col("_c"))[0]
    others = F.filter("_all", lambda k: k["c"] != F.col("_c"))
    measured = _stacked(points, labels, cols).join(packed, "_s").select(
        "_s",
        F.size("_all").alias("_k"),
        own["n"].alias("_n"),
        (mean_square(own) * fx.ratio(own["n"], own["n"] - 1)).alias("_a"),
        F.array_min(F.transform(others, mean_square)).alias("_b"),
    )
    a, b = F.col("_a"), F.col("_b")
    value = F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(F.coalesce(fx.ratio(b - a, F.greatest(a, b)), F.lit(0.0)))
    found = measured.groupBy("_s").agg(
        F.max("_k").cast("long").alias("n_clusters"), F.count(F.lit(1)).alias("n"), F.avg(F.when(b.isNotNull(), value)).alias("squared_silhouette")
    )
    names = F.array(*[F.lit(c) for c in labels])
    return found.select(F.element_at(names, F.col("_s") + 1).alias("labelling"), "n_clusters", "n", "squared_silhouette")


@dataclass(frozen=True)
class _Sides:
    """Blocks for the rows and for the columns of the checkerboard, the clusters' sizes (s, c, size), and the number of sides."""

    rows: DataFrame
    columns: DataFrame
    sizes: DataFrame
    n: int


def _sides(
    points: DataFrame, labels: Sequence[str], cols: Sequence[str], side_points: int, block_rows: int, weight: str | None = None
) -> _Sides:
    features = F.array(*[F.col(c).cast("double") for c in cols])
    merged = points.groupBy(features.alias("x"), F.array(*[F.col(c).cast("long") for c in labels]).alias("g")).agg(
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("w")
    )
    merged = materialize(merged, "silhouette-points")
    sizes = merged.select(F.posexplode("g").alias("s", "c"), "w").groupBy("s", "c").agg(F.sum("w").alias("size"), F.count("w").alias("different"))
    sizes = materialize(sizes, "cluster-sizes")
    # Every point gets the sizes of its clusters, 0 where it has none; the first labelling's small clusters keep together.
    known = merged.where(F.exists("g", lambda c: c.isNotNull()))
    for i in range(len(labels)):
        own = sizes.where(F.col("s") == i).select(F.col("c").alias("_c"), F.col("size").alias(f"_n{i}"), F.col("different").alias(f"_d{i}"))
        known = known.join(own, F.col("g")[i] == F.col("_c"), "left").drop("_c")
    known = known.withColumn("size", F.array(*[F.coalesce(f"_n{i}", F.lit(0).cast("long")) for i in range(len(labels))]))
    known = known.withColumn("g", F.transform("g", lambda c: F.coalesce(c, F.lit(0).cast("long"))))
    n_points, lanes = merged.count(), points.sparkSession.sparkContext.defaultParallelism
    n_sides = max(1, min(math.ceil(n_points / side_points), FEW_SIDES), math.ceil(n_points * len(cols) / SIDE_VALUES))

    def turns(n: int) -> float:
        """What the busiest core has to do, if n sides meet: two halves for a square of two sides, one where a side meets itself."""
        whole, last = divmod(n * (n - 1) // 2, lanes)
        halves = max(0, n - 2 * (lanes - last)) if last else n
        return (2 * whole + 2 * bool(last) + math.ceil(halves / lanes)) / n**2

    found = dict(sizes.groupBy("s").count().collect())
    first, others = found.get(0, 0), sum(found.values()) - found.get(0, 0)

    def cost(n: int) -> float:
        """Pairs that a core looks at, each twice where a task has no room for the sums of both sides, and sums on their way."""
        looks = 1 if n_points / n * (first / n + others) <= KEPT_SUMS else 2
        return turns(n) * n_points**2 / 2 * looks + n * n_points * len(labels) * SENT / lanes

    # More sides where the squares would not keep all cores busy, or have many clusters.
    n_sides = max(n_sides, min(min(range(1, BUSY_SIDES + 1), key=cost), math.ceil(n_points / LEAST_ROWS)))
    side_points = max(1, math.ceil(n_points / n_sides))
    blocks = math.ceil(side_points / block_rows)
    spread = F.xxhash64("x", "g")
    place = F.when((F.col("size")[0] > 0) & (F.col("_d0") * 4 <= side_points), F.xxhash64(F.col("g")[0])).otherwise(spread)
    numbered = known.withColumn("side", F.pmod(place, F.lit(n_sides))).withColumn("block", F.col("side") * blocks + F.pmod(spread, F.lit(blocks)))
    grouped = numbered.groupBy("side", "block").agg(F.collect_list(F.struct("x", "g", "size", "w")).alias("p"))
    flat = [F.flatten(f"p.{c}").alias(c) for c in ("x", "g", "size")]
    # Rows and columns are read from one table, so that a point has the same block and position in both.
    packed = materialize(grouped.select("side", "block", *flat, F.col("p.w").alias("w")), "silhouette-blocks")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_sides - 1).cast("long")))
    # Aliases, because two groupings that meet must not share their columns.
    rows, columns = (packed.select(F.col("side").alias(side), *[F.col(c).alias(c) for c in packed.columns if c != "side"]) for side in "ij")
    return _Sides(rows.withColumn("j", every), columns.withColumn("i", every), sizes, n_sides)


_SUMS = pa.schema(
    [("block", pa.int64()), ("pos", pa.int32()), ("w", pa.int64()), ("s", pa.int32()), ("size", pa.int64()), ("c", pa.int64()), ("d", pa.float64()), ("b", pa.float64())]
)


def _distance_sums(sides: _Sides, labellings: int) -> DataFrame:
    """Sums of distances of every point to the clusters of a side.

    Rows without ``c`` are folded: d is the sum of distances to the own cluster, b the least mean distance to another cluster that
    lies whole in the side, size that of the own cluster. Rows with ``c`` have the sum d to that cluster, of ``size``, which lies in other sides as well.
    A square of two sides gives the sums of both; its mirror image is left out.
    """

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _SUMS.empty_table()
        row, same = _Side(left, labellings), left.column("i")[0] == left.column("j")[0]
        column = row if same else _Side(right, labellings)
        width = max(sum(row.widths), sum(column.widths))
        finite = np.isfinite(row.x).all() and np.isfinite(column.x).all()
        if finite and width <= COLUMNS and width < min(row.groups, column.groups) and len(column.w) * width <= KEPT_SUMS:
            return pa.concat_tables(list(_by_cluster(row, column, both=True)))
        if len(column.w) * sum(row.widths) <= KEPT_SUMS and row.groups * WORTH_ROWS <= len(row.w):
            return pa.concat_tables(list(_mutual(row, column)))
        return pa.concat_tables([*_directed(row, column), *([] if same else _directed(column, row))])

    # One task for each square, since by a hash some tasks would get several. Those of one side have half the pairs and come last.
    met = F.col("j") * (F.col("j") - 1) / 2 + F.col("i")
    square = F.when(F.col("i") < F.col("j"), met).otherwise(sides.n * (sides.n - 1) / 2 + F.col("j")).cast("int")
    rows, columns = (
        side.where("i <= j").withColumn("square", square).repartitionById(sides.n * (sides.n + 1) // 2, "square").groupBy("square")
        for side in (sides.rows, sides.columns)
    )
    return rows.cogroup(columns).applyInArrow(kernel, "block long, pos int, w long, s int, size long, c long, d double, b double")


class _Side:
    """The points of a side, sorted so that those of the same clusters in all labellings lie side by side: a group.

    ``clusters`` has for every labelling the clusters' ids and the number of the cluster of each group, ``n`` their sizes, and
    ``whole`` tells which of them have no point in another side. A point whose own cluster has size 0 takes no part in that labelling.
    """

    def __init__(self, blocks: pa.Table, labellings: int):
        lengths = [len(w) for w in blocks.column("w")]
        w = _flat(blocks, "w")
        g, size = (_flat(blocks, c).reshape(len(w), labellings) for c in ("g", "size"))
        joint, first, group = np.unique(np.column_stack([g, size == 0]), axis=0, return_index=True, return_inverse=True)
        order = np.argsort(group.ravel(), kind="stable")
        self.w, self.g, self.size, self.group = w[order], g[order], size[order], group.ravel()[order]
        self.x = _flat(blocks, "x").astype(float).reshape(len(w), -1)[order]
        self.block = np.repeat(blocks.column("block").to_numpy(), lengths)[order]
        self.pos = np.concatenate([np.arange(n) for n in lengths])[order]
        self.groups = len(joint)
        weights = np.bincount(self.group, self.w, self.groups)
        # Points without a part in a labelling stand together as a cluster of size 0.
        found = [np.unique(joint[:, [s, labellings + s]], axis=0, return_index=True, return_inverse=True) for s in range(labellings)]
        self.clusters = [(ids[:, 0], of.ravel()) for ids, _, of in found]
        self.n = [size[first[at], s] for s, (_, at, _) in enumerate(found)]
        self.whole = [np.bincount(of, weights, len(ids)) == n for (ids, of), n in zip(self.clusters, self.n)]
        self.widths = [len(ids) for ids, _ in self.clusters]

    def numbers(self) -> np.ndarray:
        """The clusters of every point, one for each labelling, numbered over all labellings."""
        before = np.cumsum(self.widths) - self.widths
        return np.column_stack([of[self.group] + first for (_, of), first in zip(self.clusters, before)])


def _directed(row: _Side, column: _Side) -> Iterator[pa.Table]:
    """Rows of sums for the points of one side alone."""
    tiles, step = _Tiles(column), max(1, CELLS // column.groups)
    for at in range(0, len(row.w), step):
        part = slice(at, at + step)
        totals = tiles.sums(row.x[part])
        yield from _emitted(row, part, column, [_added(totals, of, len(ids)) for ids, of in column.clusters])


def _mutual(row: _Side, column: _Side) -> Iterator[pa.Table]:
    """Rows of sums for the points of both sides, from one look at each pair; also of one side that meets itself."""
    tiles, step, same = _Tiles(column), max(1, min(BLOCK_ROWS, CELLS // column.groups)), row is column
    kept = [np.zeros((len(column.w), n)) for n in row.widths]
    most, end = max(1, KEPT_SUMS // len(column.w)), 0
    while end < len(row.w):
        # No more groups at a time than there is room for.
        part = slice(end, min(end + step, int(np.searchsorted(row.group, row.group[end] + most))))
        end = part.stop
        groups, own = np.unique(row.group[part], return_inverse=True)
        back = np.zeros((len(column.w), len(groups)))
        totals = tiles.sums(row.x[part], row.w[part], own, back, *([part.start] if same else []))
        for sums, (_, of) in zip(kept, row.clusters):
            for k, group in enumerate(groups):
                sums[:, of[group]] += back[:, k]
        totals = [_added(totals, of, len(ids)) for ids, of in column.clusters]
        # What points met earlier have left for those of this part is complete by now.
        yield from _emitted(row, part, column, [t + sums[part] for t, sums in zip(totals, kept)] if same else totals)
    step = max(1, CELLS // sum(row.widths))
    for at in range(0, 0 if same else len(column.w), step):
        part = slice(at, at + step)
        yield from _emitted(column, part, row, [sums[part] for sums in kept])


def _by_cluster(row: _Side, column: _Side, both: bool) -> Iterator[pa.Table]:
    """As ``_mutual``, or ``_directed``, with sums for the clusters of every labelling and none for their joint groups."""
    tiles, numbers = _Tiles(column, _Columns, column.numbers(), sum(column.widths)), row.numbers()
    kept, same = np.zeros((len(column.w), sum(row.widths))) if both else None, both and row is column
    for at in range(0, len(row.w), BLOCK_ROWS):
        part = slice(at, at + BLOCK_ROWS)
        totals = tiles.sums(row.x[part], row.w[part], numbers[part], kept, at if same else None)
        totals = totals + kept[part] if same else totals
        yield from _emitted(row, part, column, np.split(totals, np.cumsum(column.widths)[:-1], axis=1))
    for at in range(0, len(column.w) if both and not same else 0, BLOCK_ROWS):
        part = slice(at, at + BLOCK_ROWS)
        yield from _emitted(column, part, row, np.split(kept[part], np.cumsum(row.widths)[:-1], axis=1))


def _emitted(points: _Side, part: slice, other: _Side, totals: list[np.ndarray]) -> Iterator[pa.Table]:
    """Rows of ``_SUMS`` for some points, from their sums to the clusters of the other side."""
    for s, total in enumerate(totals):
        taking, clusters = points.size[part, s] > 0, other.n[s] > 0
        (ids, _), whole, n = other.clusters[s], other.whole[s], other.n[s]
        at = [points.block[part], points.pos[part], points.w[part]]
        g, size = points.g[part, s], points.size[part, s]
        if not taking.all() or not clusters.all():
            at, g, size, total = [v[taking] for v in at], g[taking], size[taking], total[np.ix_(taking, clusters)]
            ids, whole, n = ids[clusters], whole[clusters], n[clusters]
        own = ids[None, :] == g[:, None]
        least = np.where(own | ~whole, np.inf, total / n).min(axis=1, initial=np.inf)
        least[np.isinf(least)] = np.nan
        yield _rows(*at, s, size, None, np.where(own, total, 0.0).sum(axis=1), least)
        i, k = np.nonzero(~own & ~whole[None, :])
        if len(i):
            yield _rows(*(v[i] for v in at), s, n[k], ids[k], total[i, k], None)


def _flat(blocks: pa.Table, name: str) -> np.ndarray:
    """The values of a list column, one list after the other; a missing value is NaN."""
    return pa.chunked_array([c.flatten() for c in blocks.column(name).chunks], blocks.schema.field(name).type.value_type).to_numpy()


def _rows(block, pos, w, s: int, size, c, d, b) -> pa.Table:
    """Rows of ``_SUMS``; NaN becomes NULL."""
    n = len(pos)
    values = [block, pos, w, np.full(n, s), size, pa.nulls(n) if c is None else c, d, pa.nulls(n) if b is None else b]
    return pa.table([pa.array(v, f.type, from_pandas=True) for v, f in zip(values, _SUMS)], schema=_SUMS)


def _added(totals: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Columns added up by the number, below ``n``, that ``of`` gives each."""
    order = np.argsort(of, kind="stable")
    return np.add.reduceat(totals[:, order], np.searchsorted(of[order], np.arange(n)), axis=1)


class _Members:
    """Which points of a tile belong to which group, with their weights: adds up distances, one column for each point."""

    def __init__(self, w: np.ndarray, group: np.ndarray):
        new = np.r_[True, group[1:] != group[:-1]]
        self.w, self.heads = w.astype(float), np.flatnonzero(new)
        self.ids, self.matrix = group[self.heads], None
        if len(self.heads) <= FEW_CLUSTERS:
            self.matrix = np.zeros((len(w), len(self.heads)))
            self.matrix[np.arange(len(w)), np.cumsum(new) - 1] = self.w

    def sums(self, d: np.ndarray) -> np.ndarray:
        return np.add.reduceat(d * self.w, self.heads, axis=1) if self.matrix is None else d @ self.matrix


class _Columns:
    """As ``_Members`` where every point belongs to one group of each labelling, its row of ``group``."""

    def __init__(self, w: np.ndarray, group: np.ndarray):
        self.ids, at = np.unique(group, return_inverse=True)
        self.matrix = np.zeros((len(w), len(self.ids)))
        self.matrix[np.arange(len(w))[:, None], at.reshape(group.shape)] = w[:, None]

    def sums(self, d: np.ndarray) -> np.ndarray:
        return d @ self.matrix


class _Tiles:
    """The points of a column in tiles, against which points of a row are measured. ``members`` adds up distances by ``group``."""

    def __init__(self, column: _Side, members: type = _Members, group: np.ndarray | None = None, groups: int | None = None):
        # About the middle the products below cancel least. Infinite or missing values go by differences alone.
        middle = np.median(column.x, axis=0)
        self.middle = middle if np.isfinite(middle).all() else np.zeros(len(middle))
        group, self.members = column.group if group is None else group, members
        self.groups, self.tiles = groups or column.groups, []
        for at in range(0, len(column.w), TILE[1]):
            part = slice(at, at + TILE[1])
            y = column.x[part] - self.middle
            square = (y * y).sum(axis=1)
            products = np.column_stack([-2 * y, np.ones(len(y)), square]).T
            self.tiles.append((part, y, products, square.max(), members(column.w[part], group[part])))

    def sums(self, x: np.ndarray, w=None, group=None, back=None, first: int | None = None) -> np.ndarray:
        """For every x the weighted sum of the distances to the points of each group; ``back`` gets those of the points to the groups of x.

        Where x are the column's own points from number ``first`` on, they meet no tile before their own: from there ``back`` has what they
        need once all points before them have been through. Their own tile they meet in full, and it gets nothing back.
        """
        out, x = np.zeros((len(x), self.groups)), x - self.middle
        buffer, at = np.empty(TILE), 0
        while at < len(x):
            # Rows of one tile, if they are of the column.
            rows = slice(at, min(at + TILE[0] - (0 if first is None else first + at) % TILE[0], len(x)))
            place, at = None if first is None else first + at, rows.stop
            one = x[rows]
            square = (one * one).sum(axis=1)
            wide = np.column_stack([one, square, np.ones(len(one))])
            mine = None if back is None else self.members(w[rows], group[rows])
            for part, y, products, most, members in self.tiles:
                if place is not None and part.stop <= place:
                    continue
                d = _distances(one, wide, y, products, CLOSE * (square.max() + most), buffer)
                out[rows, members.ids] += members.sums(d)
                if mine is not None and (place is None or part.start > place):
                    back[part, mine.ids] += mine.sums(d.T)
        return out


def _distances(x: np.ndarray, wide: np.ndarray, y: np.ndarray, products: np.ndarray, close: float, buffer: np.ndarray) -> np.ndarray:
    """Distances of one tile by a product of matrices; those so close that the product cancels, by differences."""
    if not np.isfinite(close):
        return np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))
    full = (len(x), len(y)) == buffer.shape
    d2 = np.matmul(wide, products, out=buffer if full else None)
    if d2.min() <= close:
        i, j = np.nonzero(d2 <= close)
        gap = x[i] - y[j]
        d2[i, j] = (gap * gap).sum(axis=1)
    return np.sqrt(d2, out=d2)


def elbow(sweep: DataFrame) -> DataFrame:
    """The k at which the fall of inertia slows down, else 4. ``sweep`` has one row per k."""
    by_k = Window.orderBy("k")
    previous = F.lag("inertia").over(by_k)
    falls = sweep.select("k", (fx.ratio(F.col("inertia") - previous, previous)).alias("fall"))
    falls = falls.withColumns({"before": F.lag("fall").over(by_k), "k_before": F.lag("k").over(by_k)})
    slowed = falls.where(F.col("before").isNotNull() & (F.col("fall") > ELBOW_FACTOR * F.col("before")))
    # The fall from k - 1 to k belongs to k - 1.
    return slowed.agg(F.coalesce(F.min("k_before"), F.lit(ELBOW_DEFAULT)).alias("elbow_k"))


def best_silhouette(sweep: DataFrame) -> DataFrame:
    """The k with the greatest silhouette, the smallest such k on ties; no row if none was measured."""
    return sweep.where(F.col("silhouette").isNotNull()).orderBy(F.desc("silhouette"), "k").limit(1).select(F.col("k").alias("best_silhouette_k"))
