"""Equal-sized tiles over a total order, without sorting the table in one task.

``ntile`` over a window with no partition sends every row to one task. A tile needs only
its upper edge, though: the element at the tile's last rank. The edges come from exact
order statistics, first of the metric and then of the id among rows tied at the edge,
and the tile itself is a comparison in the row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybasket.operators.quantiles import order_statistics, unpivot_metrics
from tallybasket.session import materialize


def tile_edges(df: DataFrame, tiles: int, keys: list[str], tie_break: str) -> DataFrame:
    """Last (value, id) of every tile but the final one, per key column, in ascending order."""
    long = unpivot_metrics(df, [tie_break], keys)

    def last_ranks(n: Column) -> list[Column]:
        size, extra = F.floor(n / tiles), n % tiles
        return [t * size + F.least(F.lit(t), extra) - 1 for t in range(1, tiles)]

    at = order_statistics(long, ["metric"], "value", last_ranks)
    edges = materialize(
        at.select("metric", F.posexplode("stats").alias("tile", "s"))
        .select("metric", "tile", F.col("s.value").alias("value"), (F.col("s.rank") - F.col("s.before")).alias("place"))
        # Fewer rows than tiles leave leading ranks below zero only for an empty table.
        .where("place >= 0"),
        "tile-edges",
    )
    tied = long.join(edges, ["metric", "value"])
    ids = order_statistics(tied, ["metric", "tile", "value", "place"], tie_break, lambda n: [F.col("place")])
    return ids.select("metric", "tile", "value", F.col("stats")[0]["value"].alias("id"))


def with_tiles(df: DataFrame, tiles: int, order: Mapping[str, Column], tie_break: str) -> DataFrame:
    """Add one tile column per entry of ``order`` (name to ascending numeric key), 1 to ``tiles``.

    Equal keys are ordered by ``tie_break``. The edges are (tiles - 1) rows per column;
    they come back to the driver and go into the plan as literals.
    """
    keyed = df.select(F.col(tie_break), *[k.cast("double").alias(name) for name, k in order.items()])
    keyed = materialize(keyed, "tile-keys")
    edges: dict[str, list] = {}
    for edge in tile_edges(keyed, tiles, list(order), tie_break).collect():
        edges.setdefault(edge["metric"], []).append((edge["value"], edge["id"]))
    for name, key in order.items():
        tile = F.lit(1)
        for value, last_id in edges.get(name, []):
            value = F.lit(value)
            past = (key.cast("double") > value) | ((key.cast("double") == value) & (F.col(tie_break) > F.lit(last_id)))
            tile = tile + past.cast("int")
        df = df.withColumn(name, F.when(key.isNotNull(), tile))
    return df
