import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybasket.operators.quantiles import DIGIT_BITS, PASSES, double_key, exact_quantiles, order_statistics
from tallybasket.operators.tiles import with_tiles

P = [0.0, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50])
def test_small_groups(spark, n):
    values = np.random.default_rng(n).normal(size=n).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, ["v"], P).first()
    assert got["n"] == n and np.allclose(got["q"], np.quantile(values, P))


def test_a_value_held_by_a_third(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(size=40_000).round(3), np.full(20_000, 1.0)])
    df = spark.createDataFrame([(float(v), int(i % 7 == 0)) for i, v in enumerate(values)], "v double, g int").repartition(6)
    got = {r["g"]: r for r in exact_quantiles(df, ["v"], P, by=["g"]).collect()}
    for g in (0, 1):
        part = values[[i for i in range(len(values)) if int(i % 7 == 0) == g]]
        assert got[g]["n"] == len(part) and np.allclose(got[g]["q"], np.quantile(part, P))


def test_keys_sort_as_doubles_do(spark):
    """Negative, tiny, huge, neighbouring and infinite values; the key is the bit pattern."""
    rng = np.random.default_rng(8)
    values = [0.0, 5e-324, 2.5e-310, 2.2250738585072014e-308, 1e-300, 0.1, 1.0, np.nextafter(1.0, 0), np.nextafter(1.0, 2), 1.7976931348623157e308]
    values += [2.0**e for e in range(-1074, 1024, 7)] + [np.nextafter(2.0**e, 0) for e in range(-1000, 1024, 9)]
    values += (np.exp(rng.normal(scale=200, size=2000))).tolist()
    values = [float(v) for v in values if np.isfinite(v)] + [float("inf")]
    values += [-v for v in values]
    got = {r["v"]: r["k"] for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", double_key(F.col("v")).alias("k")).collect()}
    for v, k in got.items():
        assert k == int(np.float64(abs(v)).view(np.int64)) * (-1 if v < 0 else 1), v


def test_windows_stay_small_on_two_million_distinct_values(spark):
    """No window partition holds more than the cells of one digit, and the quantiles are exact."""
    df = spark.range(0, 2_000_000, numPartitions=8).select(F.rand(3).alias("v"))
    values = np.sort(np.array([r["v"] for r in df.toLocalIterator()]))
    got = exact_quantiles(df, ["v"], P)
    assert np.allclose(got.first()["q"], np.quantile(values, P), rtol=0, atol=0)
    keys = np.abs(values).view(np.int64)
    for step in range(1, PASSES + 1):
        prefix = keys >> (DIGIT_BITS * (PASSES - step + 1)) if step > 1 else np.zeros_like(keys)
        cells = np.unique(np.c_[prefix, keys >> (DIGIT_BITS * (PASSES - step))], axis=0)
        assert np.unique(cells[:, 0], return_counts=True)[1].max() <= 1 << DIGIT_BITS


def test_ranks_report_ties(spark):
    df = spark.createDataFrame([(v,) for v in [5, 5, 5, 1, 9]], "v long")
    stats = order_statistics(df.withColumn("g", F.lit(1)), ["g"], "v", lambda n: [F.lit(2)]).first()["stats"]
    assert (stats[0]["value"], stats[0]["before"], stats[0]["ties"]) == (5, 1, 3)


@pytest.mark.parametrize("n", [3, 4, 11, 1000])
def test_tiles_equal_ntile(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, float(v)) for i, v in enumerate(rng.integers(0, 4, size=n))]
    df = spark.createDataFrame(rows, "id long, v double")
    tiled = {r["id"]: r["t"] for r in with_tiles(df, 5, {"t": -F.col("v")}, "id").collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    size, extra = divmod(n, 5)
    expected, at = {}, 0
    for tile in range(5):
        for _ in range(size + (tile < extra)):
            expected[order[at][0]] = tile + 1
            at += 1
    assert tiled == expected
