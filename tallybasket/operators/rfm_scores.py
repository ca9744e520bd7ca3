"""Five-level scores for recency, frequency and monetary value, and named segments from them.

The thresholds between the named segments are this library's own rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybasket.operators.tiles import with_tiles

LEVELS = 5


def score_rfm(features: DataFrame) -> DataFrame:
    """Scores 1 to 5 (5 is best; the most recent customers score 5) and the segment name."""
    order = {
        "R_Score": -F.col("Recency"),
        "F_Score": F.col("Frequency"),
        "M_Score": F.col("Monetary"),
    }
    rfm = features.select("CustomerID", "Recency", "Frequency", "Monetary")
    scored = with_tiles(rfm, LEVELS, order, "CustomerID")
    r, f, m = F.col("R_Score"), F.col("F_Score"), F.col("M_Score")
    name = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers")
        .when((r <= 2) & (m >= 4), "Can't Lose Them")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r >= 3) & (f >= 2), "Potential Loyalists")
        .when(r >= 4, "Promising")
        .otherwise("Others")
    )
    return scored.withColumn("RFM_Segment", name)


def segment_sizes(scored: DataFrame) -> DataFrame:
    return scored.groupBy("RFM_Segment").agg(F.count(F.lit(1)).alias("customers"))
