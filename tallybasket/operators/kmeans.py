"""K-means with restarts, distances to centres, the sweep over k, and PCA coordinates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybasket.functions import columns as fx
from tallybasket.operators import lloyd, metrics
from tallybasket.session import materialize

# Seed, restarts, and the limits of one fit.
SEED = 42
RESTARTS = 10
MAX_ITER = 300
TOLERANCE = 1e-4

#: Starting centres for each k; instead of drawn ones and of restarts.
Starts = Mapping[int, Sequence[Sequence[float]]]


def assemble(matrix: DataFrame, cols: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(matrix)


@dataclass(frozen=True)
class Fit:
    """A fitted model: centres in the order they were fitted, the columns they are of, and their cost.

    ``order`` puts fitted centre ``order[i]`` at place ``i``; ``sizes`` counts the rows nearest to each fitted centre.
    """

    fitted: list[list[float]]
    cols: list[str]
    inertia: float
    seed: int | None
    sizes: list[int]
    iterations: int
    order: list[int] | None = None

    @property
    def centres(self) -> list[list[float]]:
        return ordered_centres(self.fitted, self.order)

    @property
    def k(self) -> int:
        return len(self.fitted)


def ordered_centres(fitted: Sequence[Sequence[float]], order: Sequence[int] | None = None) -> list[list[float]]:
    """Centres in the fitted order, or with fitted centre ``order[i]`` at place ``i``."""
    centres = [[float(v) for v in c] for c in fitted]
    return centres if order is None else [centres[i] for i in order]


def fit_kmeans_range(
    matrix: DataFrame,
    cols: Sequence[str],
    ks: Sequence[int],
    seed: int = SEED,
    restarts: int = RESTARTS,
    max_iter: int = MAX_ITER,
    tol: float = TOLERANCE,
    starts: Starts | None = None,
) -> dict[int, Fit]:
    """For each k the fit with the least inertia among ``restarts`` seeds from ``seed`` on, or the one from ``starts``.

    All fits share their passes: reading the matrix once moves the centres of every fit that still runs. A fit ends when the squares of
    its centres' moves add up to at most ``tol`` times the mean variance of the columns. Fewer different rows than k give
    fewer centres, no rows give none.
    """
    blocks = lloyd.pack(matrix, cols)
    spread = lloyd.spread_of(blocks, len(cols))
    if starts is None:
        points, weights = lloyd.candidates(blocks, spread, max(ks), seed)
        begins = [(k, s, lloyd.plus_plus(points, weights, k, s)) for k in ks for s in range(seed, seed + restarts) if len(points)]
    else:
        begins = [(k, None, np.asarray(starts[k], dtype=float)) for k in ks]
    runs, _ = lloyd.lloyd(blocks, [centres for *_, centres in begins], max_iter, tol * spread.variance)
    fits = [
        (k, Fit(run.centres.tolist(), list(cols), run.cost, start, run.sizes, run.iterations)) for (k, start, _), run in zip(begins, runs)
    ]
    none = Fit([], list(cols), 0.0, seed, [], 0)
    return {k: min((f for of, f in fits if of == k), key=lambda f: (f.inertia, f.seed or 0), default=none) for k in ks}


def fit_kmeans(matrix: DataFrame, cols: Sequence[str], k: int, starts: Sequence[Sequence[float]] | None = None, **settings) -> Fit:
    """The best of several fits for one k; ``settings`` as in ``fit_kmeans_range``."""
    return fit_kmeans_range(matrix, cols, [k], starts=None if starts is None else {k: starts}, **settings)[k]


def distances_to_centres(cols: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Array of squared distances to each centre; the k centres are literals in the plan."""
    points = [F.col(c) for c in cols]
    return F.array(*[fx.squared_distance(points, centre) for centre in centres])


def assign_clusters(matrix: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``Cluster``, the nearest centre (the first of equals), and ``Distance_to_Center``."""
    measured = matrix.withColumn("_d2", distances_to_centres(cols, centres))
    nearest = F.array_min("_d2")
    return measured.withColumns(
        {
            "Cluster": (F.array_position("_d2", nearest) - 1).cast("int"),
            "Distance_to_Center": F.sqrt(nearest),
        }
    ).drop("_d2")


def spend_order(clustered: DataFrame, k: int) -> list[int]:
    """The k cluster ids by mean Monetary, greatest first; ids without rows come last.

    Fitted ids are arbitrary. This order gives a segment the same id in every training.
    """
    means = clustered.groupBy("Cluster").agg(F.avg("Monetary").alias("m")).orderBy(F.desc("m"), "Cluster")
    ranked = [row["Cluster"] for row in means.collect()]
    return ranked + [i for i in range(k) if i not in ranked]


def sweep(
    matrix: DataFrame,
    cols: Sequence[str],
    max_clusters: int = 10,
    restarts: int = RESTARTS,
    seed: int = SEED,
    with_silhouette: bool = True,
    starts: Starts | None = None,
    max_iter: int = MAX_ITER,
    tol: float = TOLERANCE,
) -> DataFrame:
    """One row per k from 2: inertia, silhouette, Davies-Bouldin and Calinski-Harabasz.

    ``matrix`` is read many times and should be a written table. Each k is a column of labels, so that all k share one
    grouping for the centroids, one for the spreads and one pass over the distances. The silhouette is quadratic in
    the number of customers; left out, it is NULL. That of squared distances stands beside it, linear and always there.
    """
    fits = fit_kmeans_range(matrix, cols, range(2, max_clusters + 1), seed, restarts, max_iter, tol, starts)
    labelled = matrix
    for k, fit in fits.items():
        labelled = assign_clusters(labelled, cols, fit.centres).drop("Distance_to_Center").withColumnRenamed("Cluster", f"k{k}")
    labelled = materialize(labelled, "sweep-labels")
    names = [f"k{k}" for k in fits]
    spread = metrics.measures(labelled, names, cols).select("labelling", "davies_bouldin", "calinski_harabasz")
    costs = [(k, f"k{k}", fit.inertia) for k, fit in fits.items()]
    table = labelled.sparkSession.createDataFrame(costs, "k int, labelling string, inertia double").join(spread, "labelling", "left")
    squared = metrics.squared_silhouettes(labelled, names, cols).select("labelling", "squared_silhouette")
    table = table.join(squared, "labelling", "left")
    if with_silhouette:
        table = table.join(materialize(metrics.silhouettes(labelled, names, cols), "sweep-silhouettes"), "labelling", "left")
    else:
        table = table.withColumn("silhouette", F.lit(None).cast("double"))
    return table.select("k", "inertia", "silhouette", "squared_silhouette", "davies_bouldin", "calinski_harabasz")


@dataclass(frozen=True)
class Projection:
    """PCA on the driver: feature means, loadings (one list per component) and explained shares."""

    cols: list[str]
    means: list[float]
    loadings: list[list[float]]
    explained: list[float]

    def columns(self) -> dict[str, Column]:
        n = len(self.loadings)
        out = {}
        for i, loading in enumerate(self.loadings, start=1):
            total = F.lit(0.0)
            for c, mean, weight in zip(self.cols, self.means, loading, strict=True):
                total = total + (F.col(c) - F.lit(mean)) * F.lit(weight)
            out[f"PCA{i}_{n}D"] = total
        return out


def fit_pca(matrix: DataFrame, cols: Sequence[str], n: int) -> tuple[PCAModel, Projection]:
    """Principal components; each has its largest loading positive, which fixes the sign.

    Spark fits on centred data but does not centre when it transforms, so the means are kept.
    """
    model = PCA(k=n, inputCol="features", outputCol="pca").fit(assemble(matrix, cols).select("features"))
    row = matrix.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return model, projection_of(model, cols, [row[c] for c in cols])


def projection_of(model: PCAModel, cols: Sequence[str], means: Sequence[float]) -> Projection:
    loadings = np.asarray(model.pc.toArray()).T
    signs = [1.0 if v[np.argmax(np.abs(v))] >= 0 else -1.0 for v in loadings]
    fixed = [[float(s * x) for x in v] for s, v in zip(signs, loadings, strict=True)]
    return Projection(list(cols), list(means), fixed, [float(v) for v in model.explainedVariance.toArray()])


def project(matrix: DataFrame, projection: Projection) -> DataFrame:
    return matrix.withColumns(projection.columns())
