"""Connected components by alternating stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybasket.session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Label every ``node`` with the least node of its component: ``node``, ``label``.

    ``edges`` has columns ``u`` and ``v``. Each round writes its edges to the shared folder,
    which keeps the lineage short; the number of rounds grows with the logarithm of the
    longest path.
    """
    oriented = edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    stars = materialize(oriented.distinct(), "star-edges")
    before = _state(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = larger.where(F.col("u") != F.col("v")).distinct()
        root = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = (
            larger.join(root, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        stars = materialize(smaller, "star-edges")
        after = _state(stars)
        if after == before:
            break
        before = after
    labels = stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
