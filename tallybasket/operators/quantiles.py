"""Exact order statistics and quantiles by radix selection, without gathering a group in one task.

Every value has a 64-bit key that sorts as the value does. Four passes fix sixteen bits of the key at
each wanted rank: a pass counts the values that share the bits found so far by their next sixteen, sums
these counts in order, and keeps the cell the rank falls into. A pass sums at most 65,536 cells for each
group and found prefix, whatever the number of rows or distinct values; counts combine on the map side, so a
value held by a third of the rows is one counted row. Equal values are counted once, in a written
table that all passes read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybasket.session import materialize

DIGIT_BITS = 16
PASSES = 4
MANTISSA = 1 << 52
SMALLEST_EXPONENT = -1022


def double_key(value: Column) -> Column:
    """A long that sorts as the double does: the bits of its magnitude, negated for negative values.

    NaN counts as missing before this is called; both zeros get 0.
    """
    size = F.abs(value)
    raw = F.floor(F.log2(size))
    # The logarithm may round across a power of two.
    raw = F.when(F.pow(F.lit(2.0), raw) > size, raw - 1).when(F.pow(F.lit(2.0), raw + 1) <= size, raw + 1).otherwise(raw)
    exponent = F.greatest(raw, F.lit(SMALLEST_EXPONENT))
    # Divided in two steps, since two to the power of 1,074 is no double.
    half = F.floor(exponent / 2)
    scaled = size / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), exponent - half)
    mantissa = (scaled * F.lit(float(MANTISSA))).cast("long")
    # A normal number's leading one carries into the exponent field, as it is one too low.
    bits = (exponent - SMALLEST_EXPONENT).cast("long") * F.lit(MANTISSA) + mantissa
    bits = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(2047 * MANTISSA)).otherwise(bits)
    return F.when(value < 0, -bits).otherwise(bits).cast("long")


def sort_key(df: DataFrame, value: str) -> Column:
    kind = df.schema[value].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(value).cast("long")
    return double_key(F.col(value).cast("double"))


def order_statistics(
    rows: DataFrame, by: Sequence[str], value: str, ranks: Callable[[Column], Sequence[Column]]
) -> DataFrame:
    """Elements of ``value`` at given 0-based ranks within each group of ``by``.

    ``ranks`` maps the group's row count to rank columns, which may use the columns of ``by``. Gives one row
    per group: ``by``, ``n`` and ``stats``, an array of ``(rank, value, before, ties)`` in the order of ``ranks``;
    NULL for a rank outside the group. Missing values are left out, and groups with a NULL among their keys.
    """
    by = list(by)
    present = F.col(value).isNotNull()
    if isinstance(rows.schema[value].dataType, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan(value)
    counted = rows.where(present).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counted = materialize(counted.withColumn("_key", sort_key(counted, "_v")), "order-counts")
    groups = counted.groupBy(*by).agg(F.sum("_n").alias("n"))
    wanted = groups.select(*by, "n", F.posexplode(F.array(*[r.cast("long") for r in ranks(F.col("n"))])).alias("_i", "_rank"))
    found = wanted.withColumn("_prefix", F.lit(0).cast("long")).withColumn("_before", F.lit(0).cast("long"))
    found = found.where((F.col("_rank") >= 0) & (F.col("_rank") < F.col("n"))).drop("n")
    for step in range(1, PASSES + 1):
        shift = DIGIT_BITS * (PASSES - step)
        # The prefixes of all ranks of a group that share them are counted once.
        open_cells = found.select(*by, "_prefix").distinct()
        prefix = F.shiftright("_key", shift + DIGIT_BITS) if step > 1 else F.lit(0).cast("long")
        inside = counted.withColumn("_prefix", prefix).join(open_cells, [*by, "_prefix"])
        cells = inside.groupBy(*by, "_prefix", F.shiftright("_key", shift).alias("_cell")).agg(
            F.sum("_n").alias("_n"), F.max("_v").alias("_v")
        )
        running = Window.partitionBy(*by, "_prefix").orderBy("_cell")
        cells = cells.withColumn("_upto", F.sum("_n").over(running))
        at = F.col("_rank") - F.col("_before")
        found = (
            found.join(cells, [*by, "_prefix"])
            .where((at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_n")))
            .select(
                *by,
                "_i",
                "_rank",
                F.col("_cell").alias("_prefix"),
                (F.col("_before") + F.col("_upto") - F.col("_n")).alias("_before"),
                "_v",
                F.col("_n").alias("_ties"),
            )
        )
        # One small row per rank: written, since the next pass reads it twice.
        found = materialize(found if step == PASSES else found.drop("_v", "_ties"), "order-found")
    stat = F.struct(
        F.col("_rank").alias("rank"), F.col("_v").alias("value"), F.col("_before").alias("before"), F.col("_ties").alias("ties")
    )
    placed = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_i", stat))).alias("_stats"))
    count = len(ranks(F.col("n")))
    stats = F.array(*[F.col("_stats")[F.lit(i)] for i in range(count)])
    return groups.join(placed, by, "left").select(*by, "n", stats.alias("stats"))


def unpivot_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per (key, metric) with a double ``value``."""
    wide = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(keys), list(metrics), "metric", "value")


def exact_quantiles(
    df: DataFrame, metrics: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles per group and metric: ``by``, ``metric``, ``n``, ``q``."""
    keys = [*by, "metric"]

    def ranks(n: Column) -> list[Column]:
        out = []
        for p in probabilities:
            out += [F.floor(F.lit(p) * (n - 1)), F.ceil(F.lit(p) * (n - 1))]
        return out

    stats = order_statistics(unpivot_metrics(df, list(by), metrics), keys, "value", ranks)
    values = []
    for i, p in enumerate(probabilities):
        lower, upper = F.col("stats")[2 * i], F.col("stats")[2 * i + 1]
        share = F.lit(p) * (F.col("n") - 1) - lower["rank"]
        values.append(lower["value"] + (upper["value"] - lower["value"]) * share)
    return stats.select(*keys, "n", F.array(*values).alias("q"))


def quantile_row(df: DataFrame, metrics: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """One row with an array of quantiles per metric, named after the metric."""
    long = exact_quantiles(df, metrics, probabilities)
    return long.agg(*[F.max(F.when(F.col("metric") == m, F.col("q"))).alias(m) for m in metrics])
