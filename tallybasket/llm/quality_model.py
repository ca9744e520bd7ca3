"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Every text becomes about twenty ratios of its statistics, standardised by the labelled rows. Random
Fourier features approximate a Gaussian kernel over them. The labelled rows are cut into folds by a hash of
the id; each fold's partition sums its normal equations, and only these sums (of fixed size) go to the
driver, which solves the ridge system of all folds and those that leave one fold out. The left-out scores
are counted in bins of fixed number by Spark; pooling adjacent violators over the bins gives the monotone
step from score to probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybasket.llm.common import saved, text_or_empty
from tallybasket.llm.statistics import COLUMNS, with_statistics

#: Bound of the labelled rows that the fit uses; beyond it a seeded hash of the id picks about so many.
TRAIN_ROWS = 100_000
RANDOM_FEATURES = 256
FOLDS = 5
RIDGE = 1e-3
BINS = 400
#: Standardised ratios beyond this many deviations are drawn in.
CLIP = 4.0
SEED = 11


def ratios() -> list[Column]:
    """The inputs of the model, from the columns of ``statistics.COLUMNS``."""
    c = {name: F.col(name).cast("double") for name in COLUMNS}
    words, chars, lines = (F.greatest(c[x], F.lit(1.0)) for x in ("n_words", "word_chars", "n_lines"))
    per_word = ["n_repeat_words", "n_caps_words", "n_symbol_words", "n_stop_words", "n_lower_start", "n_distinct_words", "n_pipes", "n_exclamations", "n_long_words"]
    per_char = ["n_symbols", "n_upper", "n_lower", "n_digits", "n_punctuation", "n_wide"]
    return [
        F.log1p(c["n_words"]),
        c["word_chars"] / words,
        F.log1p(c["n_words"] / lines),
        c["n_dup_lines"] / lines,
        F.log1p(c["longest_word"]),
        *(c[x] / words for x in per_word),
        *(c[x] / chars for x in per_char),
    ]


N_RATIOS = 20


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the random features and the constant
    knots: np.ndarray  # scores, increasing
    values: np.ndarray  # probabilities at the knots, not decreasing

    def raw(self, x: np.ndarray) -> np.ndarray:
        return features(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), 0.5)
        return np.interp(self.raw(x), self.knots, self.values)


def features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel whose width is the root of the number of inputs, and a constant."""
    rng = np.random.default_rng(SEED)
    directions = rng.normal(size=(x.shape[1], RANDOM_FEATURES)) / np.sqrt(x.shape[1])
    phases = rng.uniform(0, 2 * np.pi, RANDOM_FEATURES)
    z = np.clip((x - mean) / scale, -CLIP, CLIP)
    return np.c_[np.sqrt(2 / RANDOM_FEATURES) * np.cos(z @ directions + phases), np.ones(len(x))]


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("x").flatten(), dtype=np.float64).reshape(batch.num_rows, -1)


def isotonic(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Means per bin, pooled until they do not decrease."""
    blocks: list[list[float]] = []  # [count, total, bins]
    for n, t in zip(count, total):
        blocks.append([n, t, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, t2, b2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + t2, blocks[-1][2] + b2]
    return np.concatenate([np.full(b, t / n) for n, t, b in blocks]) if blocks else np.zeros(0)


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """``rows``: ``doc_id``, ``x`` (array<double>) and ``y`` (0 or 1), written already."""
    total = rows.count()
    share = min(1.0, train_rows / max(total, 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(FOLDS)).cast("int").alias("fold")
    rows = saved(rows.where(drawn).select("x", F.col("y").cast("double").alias("y"), fold), "quality-train")
    sums = rows.agg(*[f(F.col("x")[i]).alias(f"{n}{i}") for i in range(N_RATIOS) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([sums[f"m{i}"] or 0.0 for i in range(N_RATIOS)])
    scale = np.array([sums[f"s{i}"] or 1.0 for i in range(N_RATIOS)])
    size = RANDOM_FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            z, y, of = features(_rows(batch), mean, scale), np.asarray(batch.column("y")), np.asarray(batch.column("fold"))
            for k in np.unique(of):
                a, b = found.get(int(k), (np.zeros((size, size)), np.zeros(size)))
                found[int(k)] = (a + z[of == k].T @ z[of == k], b + z[of == k].T @ y[of == k])
        for k, (a, b) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([a.ravel()], pa.list_(pa.float64())), pa.array([b], pa.list_(pa.float64()))], names=["fold", "a", "b"])

    a, b = np.zeros((FOLDS, size, size)), np.zeros((FOLDS, size))
    for row in rows.repartition(FOLDS, "fold").mapInArrow(equations, "fold int, a array<double>, b array<double>").toLocalIterator():
        a[row["fold"]] += np.array(row["a"]).reshape(size, size)
        b[row["fold"]] += np.array(row["b"])
    if not a[:, -1, -1].sum():
        return Model(mean, scale, np.zeros(size), np.zeros(0), np.zeros(0))

    def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.linalg.solve(a + RIDGE * max(a[-1, -1], 1.0) * np.eye(size), b)

    left_out = [solve(a.sum(0) - a[k], b.sum(0) - b[k]) for k in range(FOLDS)]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, of = features(_rows(batch), mean, scale), np.asarray(batch.column("fold"))
            raw = np.einsum("ij,ij->i", z, np.stack(left_out)[of])
            at = np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw), batch.column("y")], names=["bin", "raw", "y"])

    counted = rows.select("x", "y", "fold").mapInArrow(binned, "bin int, raw double, y double")
    bins = counted.groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("y"), F.avg("raw").alias("raw")).orderBy("bin").collect()
    values = isotonic(np.array([r["n"] for r in bins]), np.array([r["y"] for r in bins]))
    return Model(mean, scale, solve(a.sum(0), b.sum(0)), np.array([r["raw"] for r in bins]), values)


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with their label as ``y``; ids without one label of 0 or 1, or with labels that differ, are left out."""
    known = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min("quality").alias("y"), F.max("quality").alias("most")).where(F.col("y") == F.col("most")).drop("most")
    return rows.join(known, "doc_id")


def held_out() -> Column:
    """Ids whose labels are never learned: crc32 of the id as text leaves 1 divided by 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5) of every row of ``docs``.

    Only statistics of the text enter a score. Null texts count as empty and get the score of the empty text.
    Repeated rows give repeated rows; a null id is scored and never labelled. Without any label to learn from
    every score is 0.5. An empty table gives an empty result; other columns are ignored, but for those named
    in ``carry``, which are handed through.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, text_or_empty().alias("text"))
    measured = with_statistics(rows).select("doc_id", *carry, F.array(*ratios()).alias("x"))
    measured = saved(measured, "quality-statistics")
    known = saved(labelled(measured.where(~held_out()).select("doc_id", "x"), labels), "quality-labelled")
    model = fit(known, train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.clip(model.score(_rows(batch)), 0.0, 1.0) if batch.num_rows else np.zeros(0)
            columns = [batch.column(c) for c in ("doc_id", *carry)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], names=["doc_id", *carry, "score"])

    kept = [f for f in measured.schema.fields if f.name != "x"]
    scored = measured.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", *carry, held_out().alias("held_out"), "score", predicted)
