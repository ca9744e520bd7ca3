"""Exact top-k inner products by norm-bucketed retrieval (after Teflioudi, Gemulla and Mykytiuk, 2015).

Vectors are grouped by length (norm) into buckets and packed into blocks of bounded size, queries into
blocks of their own. A query's lower bound comes first: the k-th best product with the longest vectors
(one block) is a score that the true k-th best reaches. In a bucket whose longest vector has norm b, a
vector can reach the bound t of query q only if its cosine is at least t / (|q| b): the bucket's local
threshold. Above 1 the bucket is skipped. A low threshold prunes by length: vectors shorter than t / |q|
cannot reach it. A high one prunes by coordinates: in a query's largest coordinates a vector of that
cosine must lie inside an interval (Cauchy-Schwarz on the rest). What is left is verified by the product.

Each query block meets each vector block once. Vector blocks are dealt into groups and query blocks into slices, and a group
meets a slice as on a checkerboard, so a block is sent once for each of the other side and not once for each of its blocks. A task keeps the best of
its queries from one vector block to the next: they raise the bound, and what leaves it is k rows for each query and group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybasket.llm.common import prepare_tasks, saved

#: Rows of a block of vectors and of queries.
BLOCK_ROWS, QUERY_ROWS = 2048, 512
BLOCK_BYTES = 4 << 20
#: Vector blocks of a group, if there are groups enough for all cores; query blocks of a slice.
GROUP_BLOCKS, SLICE_BLOCKS = 16, 128
#: Dimensions that get a first bound; vectors of others are compared without one.
SEED_WIDTHS = 4
#: From this local cosine threshold on, coordinates prune better than length.
COORDINATES_FROM = 0.5
FOCUS = 4


def scaled(vectors: DataFrame, factor: float) -> DataFrame:
    """``vec_id`` and ``v``: every component floor(factor * x) as a whole double; unusable vectors left out."""
    x = F.col("embedding").cast("array<double>")
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(factor))).cast("double"))
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).distinct()


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by score, then id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= edge)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))


def block_top(q_ids, q, bounds, ids, v, norms, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query (ids, scores) of the block's vectors that may be among its k best."""
    q_norms = np.sqrt((q * q).sum(axis=1))
    longest = norms.max() if len(norms) else 0.0
    slack = 1e-9  # a little wider than rounding; what passes is verified by its product
    for i in range(len(q)):
        t = bounds[i]
        reach = q_norms[i] * longest
        rows = None
        if t > reach * (1 + slack):
            continue
        if t > 0 and reach > 0:
            cosine = t / reach
            rows = norms * q_norms[i] * (1 + slack) >= t
            if cosine >= COORDINATES_FROM:
                focus = np.argsort(-np.abs(q[i]))[:FOCUS]
                with np.errstate(divide="ignore", invalid="ignore"):
                    a = q[i, focus] / q_norms[i]
                    low = np.maximum(-1.0, a * cosine - np.sqrt(np.maximum(0, (1 - cosine**2) * (1 - a**2))))
                    high = np.minimum(1.0, a * cosine + np.sqrt(np.maximum(0, (1 - cosine**2) * (1 - a**2))))
                    # Where the query's own coordinate lies outside the cone's edge, the edge is the axis itself.
                    low = np.where(-a >= cosine, -1.0, low)
                    high = np.where(a >= cosine, 1.0, high)
                    unit = v[:, focus] / norms[:, None]
                    rows &= ((unit >= low - 1e-9) & (unit <= high + 1e-9)).all(axis=1)
        at = np.flatnonzero(rows) if rows is not None else np.arange(len(ids))
        at = at[ids[at] != q_ids[i]]
        scores = v[at] @ q[i]
        good = scores >= t
        at, scores = at[good], scores[good]
        best = _best(scores, ids[at], k)
        yield i, ids[at][best], scores[best]


def _merged(best: tuple, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) of two such lists; a pair that is in both counts once."""
    ids, scores = np.r_[best[0], ids], np.r_[best[1], scores]
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])]
    return ids[new][:k], scores[new][:k]


class _Best:
    """The best of the queries of some blocks, over the vector blocks they have met so far."""

    def __init__(self, k: int):
        self.k, self.blocks = k, {}

    def meet(self, number: int, q_ids, q, bounds, ids, v) -> None:
        if number not in self.blocks:
            self.blocks[number] = (q_ids, np.array(bounds), {})
        _, bounds, best = self.blocks[number]
        nothing = np.zeros(0, np.int64), np.zeros(0)
        for i, found, scores in block_top(q_ids, q, bounds, ids, v, _norms(v), self.k):
            if len(found):
                best[i] = _merged(best.get(i, nothing), found, scores, self.k)
                if len(best[i][0]) == self.k:
                    bounds[i] = max(bounds[i], best[i][1][-1])

    def flush(self) -> Iterator[pa.RecordBatch]:
        for q_ids, _, best in self.blocks.values():
            yield _result(q_ids, ((i, *pair) for i, pair in best.items()))
        self.blocks = {}


BLOCK = "ids array<long>, data array<double>, width int"


def _pack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive vectors of one dimension: at most ``size`` rows and ``BLOCK_BYTES``."""
    for batch in batches:
        widths = np.asarray(batch.column("width"))
        at = 0
        while at < len(widths):
            step = max(1, min(size, BLOCK_BYTES // (8 * max(1, int(widths[at])))))
            stop = at + int(np.argmax(np.r_[widths[at : at + step] != widths[at], True]))
            part = batch.slice(at, stop - at)
            data = np.asarray(part.column("v").flatten())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([np.asarray(part.column("vec_id"))], pa.list_(pa.int64())),
                    pa.array([data], pa.list_(pa.float64())),
                    pa.array([widths[at]], pa.int32()),
                ],
                names=["ids", "data", "width"],
            )
            at = stop


def _arrays(ids, data, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.asarray(ids, dtype=np.int64)
    return ids, np.asarray(data, dtype=np.float64).reshape(len(ids), width)


def _norms(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v * v).sum(axis=1))


def _result(q_ids, found) -> pa.RecordBatch:
    found = list(found)
    counts = [len(f[1]) for f in found]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.asarray([q_ids[f[0]] for f in found], dtype=np.int64), counts)),
            pa.array(np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)),
            pa.array(np.concatenate([f[2] for f in found]) if found else np.zeros(0)),
        ],
        names=["query_id", "vec_id", "score"],
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 64.0) -> DataFrame:
    """Each query's ``k`` best vectors by inner product: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both tables have ``vec_id`` and ``embedding``; components are turned into floor(``factor`` * x), and
    scores are whole numbers (exact while below 2**53). Ties go to the smaller vec_id; vectors with the
    query's own id are not its candidates; a query with fewer candidates gets all of them. Vectors that are
    null, hold null or non-finite components, or have no id take no part. Rows that repeat count once; vectors
    with one id and different components stand for themselves, as candidates and as queries. Vectors of
    different dimension do not meet. Empty tables give an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    prepare_tasks(spark)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    rows = saved(scaled(vectors, factor).withColumn("norm", norm).withColumn("width", F.size("v")), "vectors")
    order = [F.asc("width"), F.desc("norm"), F.asc("vec_id")]
    by_norm = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = saved(by_norm.mapInArrow(lambda b: _pack(b, BLOCK_ROWS), BLOCK), "vector-blocks")
    asked = scaled(queries, factor).withColumn("width", F.size("v")).repartition("vec_id").sortWithinPartitions("width")
    asked = asked.mapInArrow(lambda b: _pack(b, QUERY_ROWS), BLOCK).withColumn("number", F.monotonically_increasing_id())
    asked = saved(asked, "query-blocks")
    # The longest vectors of each dimension, one block in all, give every query its first bound.
    seeds = {}
    for width, n in rows.groupBy("width").count().orderBy(F.desc("count")).limit(SEED_WIDTHS).collect():
        take = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, width)) // SEED_WIDTHS))
        best = rows.where(F.col("width") == width).orderBy(F.desc("norm"), "vec_id").limit(take).collect()
        seeds[width] = _arrays([r["vec_id"] for r in best], [c for r in best for c in r["v"]], width)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = []
            for ids, data, width in zip(*(batch.column(c).to_pylist() for c in ("ids", "data", "width"))):
                q_ids, q = _arrays(ids, data, width)
                s_ids, s = seeds.get(width, _arrays([], [], width))
                own = np.full(len(q), -np.inf)
                for i in range(len(q)):
                    scores = s[s_ids != q_ids[i]] @ q[i]
                    if len(scores) >= k:
                        own[i] = np.partition(scores, len(scores) - k)[len(scores) - k]
                bounds.append(own)
            columns = [batch.column(c) for c in ("ids", "data", "width", "number")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bounds, pa.list_(pa.float64()))], names=["q_ids", "q", "width", "number", "bounds"])

    n_asked = asked.count()
    asked = asked.mapInArrow(bounded, "q_ids array<long>, q array<double>, width int, number long, bounds array<double>")
    # Every query block goes to every group of vector blocks, every vector block to every slice of query blocks.
    n_blocks = blocks.count()
    groups = max(1, min(n_blocks, max(4 * spark.sparkContext.defaultParallelism, -(-n_blocks // GROUP_BLOCKS))))
    slices = max(1, -(-n_asked // SLICE_BLOCKS))
    group = F.pmod(F.xxhash64(F.element_at("ids", 1), "width"), F.lit(groups)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    here = blocks.withColumn("group", group).withColumn("slice", each(slices))
    there = asked.withColumn("slice", F.pmod(F.xxhash64("number"), F.lit(slices)).cast("int")).withColumn("group", each(groups))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at] for c in batch.schema.names}
                width, number = row["width"].as_py(), row["number"].as_py()
                if len(best.blocks) >= 2 * SLICE_BLOCKS and number not in best.blocks:
                    yield from best.flush()
                ids, v = _arrays(row["ids"].values, row["data"].values, width)
                q_ids, q = _arrays(row["q_ids"].values, row["q"].values, width)
                best.meet(number, q_ids, q, np.asarray(row["bounds"].values), ids, v)
        yield from best.flush()

    # The planner takes the exploded side for as small as the blocks it is made of, and would broadcast it: both sides are shuffled.
    met = here.hint("merge").join(there, ["group", "slice", "width"]).select("ids", "data", "width", "number", "q_ids", "q", "bounds")
    found = met.mapInArrow(compare, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
