"""K-means fits that share their passes over the data (Lloyd 1982).

Points are packed once into blocks of near points, each with its mean, its radius about the mean and its sum of squares.
A pass serves every fit that still runs: it adds up, for every (fit, cluster), the number, the sum and the cost of the points
nearest to that centre. Where the triangle inequality puts a whole block at one centre (the second centre is farther from the mean
than the first by more than the diameter), the block's sums stand for its points; only blocks that a border
crosses are looked into. Fits that have converged drop out of the next pass.

Starting centres come from k-means|| (Bahmani et al. 2012), in passes that all fits share too: points are drawn
by a hash of their values in proportion to their cost, so a rerun or another partitioning draws the same. The draw only
chooses where fits begin; every pass reads all points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybasket.session import materialize, prepare_tasks

#: Points of a block at most.
BLOCK_ROWS = 64
#: Points looked into at a time for one fit.
STEP_ROWS = 1 << 16
#: Rounds of the draw of starting centres, and points drawn in each for every cluster of the largest fit.
ROUNDS, DRAWN = 4, 8
#: Passes of Lloyd's iteration over the drawn points alone, on the driver.
LOCAL_ITER = 30


def _leaves(x: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Halves by the median of the widest column, down to ``BLOCK_ROWS`` rows."""
    stack = [rows]
    while stack:
        rows = stack.pop()
        if len(rows) <= BLOCK_ROWS:
            yield rows
            continue
        own = x[rows]
        middle = len(rows) // 2
        order = np.argpartition(own[:, np.argmax(own.max(axis=0) - own.min(axis=0))], middle)
        stack += [rows[order[middle:]], rows[order[:middle]]]


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel()))


def pack(matrix: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Blocks of the points, written: n, mean, radius, square (sum of squares about the mean) and x (all values, point by point)."""
    prepare_tasks(matrix.sparkSession)
    width = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([np.asarray(c, dtype=float) for c in batch.columns]) + 0.0
            leaves = list(_leaves(x, np.arange(len(x))))
            n = np.array([len(rows) for rows in leaves])
            mean = np.array([x[rows].mean(axis=0) for rows in leaves])
            x = x[np.concatenate(leaves)]
            far = ((x - np.repeat(mean, n, axis=0)) ** 2).sum(axis=1)
            begin = np.cumsum(n) - n
            radius, square = np.sqrt(np.maximum.reduceat(far, begin)), np.add.reduceat(far, begin)
            offsets = pa.array(np.r_[0, np.cumsum(n)] * width, pa.int32())
            columns = [pa.array(n), _lists(mean), pa.array(radius), pa.array(square), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "mean", "radius", "square", "x"])

    values = matrix.select(*[F.col(c).cast("double") for c in cols])
    lanes = matrix.sparkSession.sparkContext.defaultParallelism
    if values.rdd.getNumPartitions() < lanes:
        # Every pass has a task for each file; a table in few files would leave cores idle in all of them.
        values = values.repartition(lanes)
    packed = values.mapInArrow(run, "n long, mean array<double>, radius double, square double, x array<double>")
    return materialize(packed, "point-blocks")


def _blocks(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    flat = (batch.column(c).flatten() for c in ("mean", "x"))
    mean, x = (np.asarray(v).reshape(-1, width) for v in flat)
    return *(np.asarray(batch.column(c)) for c in ("n", "radius", "square")), mean, x


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances by differences, which keeps close centres apart."""
    total = np.zeros((len(x), len(centres)))
    for f in range(x.shape[1]):
        gap = x[:, f, None] - centres[None, :, f]
        gap *= gap
        total += gap
    return total


def _add(sums: np.ndarray, nearest: np.ndarray, n: np.ndarray, x: np.ndarray, cost: np.ndarray) -> None:
    """Add weighted points to the rows (number, cost, sums of columns) of their centres."""
    k = len(sums)
    sums[:, 0] += np.bincount(nearest, n, k)
    sums[:, 1] += np.bincount(nearest, cost, k)
    for f in range(x.shape[1]):
        sums[:, 2 + f] += np.bincount(nearest, x[:, f] * n, k)


def _fit_sums(centres: np.ndarray, n, radius, square, mean, x) -> np.ndarray:
    """Number, cost and sums per centre of one batch of blocks; the first of equally near centres takes a point."""
    sums = np.zeros((len(centres), 2 + x.shape[1]))
    d2 = _squares(mean, centres)
    nearest = d2.argmin(axis=1)
    if len(centres) == 1:
        whole = np.ones(len(n), bool)
    else:
        two = np.sqrt(np.partition(d2, 1, axis=1)[:, :2])
        # A margin for rounding, so that a border never passes through a block unseen.
        whole = two[:, 1] - two[:, 0] > 2 * radius * (1 + 1e-9) + 1e-9 * two[:, 1]
    taken = np.flatnonzero(whole)
    _add(sums, nearest[taken], n[taken], mean[taken], square[taken] + n[taken] * d2[taken, nearest[taken]])
    rest = np.flatnonzero(np.repeat(~whole, n))
    for at in range(0, len(rest), STEP_ROWS):
        points = x[rest[at : at + STEP_ROWS]]
        d2 = _squares(points, centres)
        nearest = d2.argmin(axis=1)
        _add(sums, nearest, np.ones(len(points)), points, d2[np.arange(len(points)), nearest])
    return sums


def sums_of(blocks: DataFrame, fits: Sequence[np.ndarray]) -> list[np.ndarray]:
    """One pass: for every fit's centres a matrix of number, cost and column sums. The driver gets a row for each centre."""
    fits, width = [np.asarray(c, dtype=float) for c in fits], fits[0].shape[1]
    names = ["n", "cost", *(f"s{i}" for i in range(width))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(c), 2 + width)) for c in fits]
        for batch in batches:
            own = _blocks(batch, width)
            for total, centres in zip(totals, fits):
                total += _fit_sums(centres, *own)
        fit = np.repeat(np.arange(len(fits)), [len(c) for c in fits])
        cluster = np.concatenate([np.arange(len(c)) for c in fits])
        every = np.concatenate(totals)
        full = every[:, 0] > 0
        columns = [pa.array(fit[full].astype(np.int32)), pa.array(cluster[full].astype(np.int32)), *(pa.array(v) for v in every[full].T)]
        yield pa.RecordBatch.from_arrays(columns, names=["fit", "cluster", *names])

    schema = "fit int, cluster int, " + ", ".join(f"{c} double" for c in names)
    added = blocks.mapInArrow(run, schema).groupBy("fit", "cluster").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    out = [np.zeros((len(c), 2 + width)) for c in fits]
    fit, cluster, *values = (np.asarray(added.column(c)) for c in ["fit", "cluster", *names])
    for row, (i, j) in enumerate(zip(fit.tolist(), cluster.tolist())):
        out[i][j] = [v[row] for v in values]
    return out


@dataclass
class Run:
    """One fit: its centres, and once it has ended its cost, the points of each centre and how often the centres moved."""

    centres: np.ndarray
    cost: float = float("nan")
    sizes: list[int] = field(default_factory=list)
    iterations: int = 0
    ending: bool = False


@dataclass(frozen=True)
class Spread:
    """Number and mean of all points, and their sum of squares about the mean."""

    n: int
    mean: np.ndarray
    square: float

    @property
    def variance(self) -> float:
        """Mean variance of the columns."""
        return self.square / self.n / len(self.mean) if self.n else 0.0


def spread_of(blocks: DataFrame, width: int) -> Spread:
    """From the blocks' own sums; no point is read."""
    mean = [F.col("mean")[i] for i in range(width)]
    first = blocks.agg(F.sum("n"), *[F.sum(F.col("n") * m) / F.sum("n") for m in mean]).first()
    if not first[0]:
        return Spread(0, np.zeros(width), 0.0)
    middle = np.array(first[1:], dtype=float)
    far = sum((m - float(c)) * (m - float(c)) for m, c in zip(mean, middle))
    return Spread(first[0], middle, float(blocks.agg(F.sum(F.col("square") + F.col("n") * far)).first()[0]))


def lloyd(blocks: DataFrame, starts: Sequence[np.ndarray], max_iter: int, tol: float) -> tuple[list[Run], int]:
    """All fits from their starting centres, and the number of passes.

    A fit ends when the squares of its centres' moves add up to at most ``tol``, or after ``max_iter`` moves; its cost is that of its
    last centres, so it takes one pass more than it moves. A centre without points stays.
    """
    runs = [Run(np.asarray(start, dtype=float), ending=max_iter == 0) for start in starts]
    running, passes = list(runs), 0
    while running:
        passes += 1
        for run, sums in zip(running, sums_of(blocks, [r.centres for r in running])):
            if run.ending:
                run.cost, run.sizes = float(sums[:, 1].sum()), sums[:, 0].astype(int).tolist()
                continue
            full = sums[:, 0] > 0
            moved = run.centres.copy()
            moved[full] = sums[full, 2:] / sums[full, :1]
            gap = ((moved - run.centres) ** 2).sum()
            run.centres, run.iterations = moved, run.iterations + 1
            run.ending = gap <= tol or run.iterations >= max_iter
        running = [r for r in running if not r.sizes]
    return runs, passes


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _uniform(x: np.ndarray, salt: int) -> np.ndarray:
    """A number from 0 to 1 for every point, by its values."""
    h = np.full(len(x), salt, np.uint64)
    for column in np.ascontiguousarray(x.T).view(np.uint64):
        h = _mixed(h + column * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    return (h >> np.uint64(11)) / float(1 << 53)


def _draw(blocks: DataFrame, near: np.ndarray, expected: int, cost: float, salt: int) -> tuple[float, np.ndarray]:
    """Cost of ``near``, and about ``expected`` different points drawn in proportion to theirs, ``cost`` being that of all."""
    width = near.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, drawn = 0.0, [np.zeros((0, width))]
        for batch in batches:
            x = _blocks(batch, width)[-1]
            for at in range(0, len(x), STEP_ROWS):
                part = x[at : at + STEP_ROWS]
                d2 = np.full(len(part), np.inf)
                for c in range(0, len(near), 64):
                    d2 = np.minimum(d2, _squares(part, near[c : c + 64]).min(axis=1))
                total += float(d2.sum())
                drawn.append(part[_uniform(part, salt) < expected * d2 / cost])
        found = np.unique(np.concatenate(drawn), axis=0)
        columns = [pa.array([0.0] * len(found) + [total]), pa.array([*found.tolist(), None], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cost", "x"])

    rows = blocks.mapInArrow(run, "cost double, x array<double>").groupBy("x").agg(F.sum("cost").alias("cost")).collect()
    drawn = sorted(tuple(r["x"]) for r in rows if r["x"] is not None)
    return sum(r["cost"] for r in rows if r["x"] is None), np.array(drawn).reshape(-1, width)


def candidates(blocks: DataFrame, spread: Spread, k: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """A few hundred points that fits can begin at, with the number of points near each."""
    if not spread.n:
        return np.zeros((0, len(spread.mean))), np.zeros(0)
    near, cost = spread.mean[None, :], spread.square
    found = near[:0]
    for turn in range(ROUNDS):
        if not cost:
            break
        # The cost of the points before the last round: at most too large, so at most too few are drawn.
        cost, drawn = _draw(blocks, near, DRAWN * k, cost, salt + turn)
        found = np.unique(np.concatenate([found, drawn]), axis=0)
        near = found if len(found) else near
    return near, sums_of(blocks, [near])[0][:, 0]


def plus_plus(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Starting centres among weighted points (Arthur & Vassilvitskii 2007), moved by Lloyd's iteration over these points.

    Each centre is the best of a few draws. Fewer than k different points give as many centres.
    """
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    near = _squares(points, points[chosen])[:, 0]
    while len(chosen) < k and (near * weights).sum() > 0:
        share = near * weights / (near * weights).sum()
        tries = np.unique(rng.choice(len(points), size=2 + int(np.log(k)), p=share))
        reach = np.minimum(near[:, None], _squares(points, points[tries]))
        best = int((reach * weights[:, None]).sum(axis=0).argmin())
        chosen.append(int(tries[best]))
        near = reach[:, best]
    centres = points[chosen]
    for _ in range(LOCAL_ITER):
        nearest = _squares(points, centres).argmin(axis=1)
        sums = np.zeros((len(centres), 2 + points.shape[1]))
        _add(sums, nearest, weights, points, weights)
        full = sums[:, 0] > 0
        moved = centres.copy()
        moved[full] = sums[full, 2:] / sums[full, :1]
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres
