"""The segment dimension and the joins and counts that use it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybasket.functions import columns as fx

# Segment names, descriptions, goals, actions and indicators by cluster id.
SEGMENTS = [
    (
        0,
        "VIP Customers",
        "High-frequency, high-value customers who purchase regularly and recently",
        "Retain and grow",
        [
            "Exclusive loyalty program",
            "Personalized recommendations",
            "Early access to new products",
            "Dedicated account manager",
        ],
        [
            "Increase purchase frequency by 20%",
            "Increase average order value by 15%",
            "Maintain churn rate below 5%",
        ],
    ),
    (
        1,
        "Occasional Shoppers",
        "Infrequent buyers with moderate recency and lower spend",
        "Increase frequency and loyalty",
        [
            "Re-engagement campaigns",
            "Cross-selling based on history",
            "Loyalty program enrollment",
            "Personalized win-back offers",
        ],
        [
            "Increase purchase frequency to 3+ per year",
            "Convert 30% to Regular Loyalists",
            "Increase retention rate by 25%",
        ],
    ),
    (
        2,
        "Regular Loyalists",
        "Customers with good purchase frequency and value but not recently active",
        "Re-activate and prevent churn",
        [
            "Win-back campaigns",
            "Survey to understand churn reasons",
            "Product usage reminders",
            "Re-activation bundles",
        ],
        [
            "Re-activate 40% of dormant customers",
            "Reduce churn rate by 30%",
            "Increase CLV by 20%",
        ],
    ),
    (
        3,
        "At Risk Customers",
        "Customers who haven't purchased in a long time (dormant)",
        "Win back or understand churn",
        [
            "Aggressive win-back campaigns",
            "Exit surveys",
            "Special comeback offers",
            "Review pain points",
        ],
        [
            "Win back 15% of churned customers",
            "Reduce churn rate by 20%",
            "Improve CSAT scores",
        ],
    ),
]
NO_DESCRIPTION = "No description available"

SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("Cluster", T.IntegerType()),
        T.StructField("Segment_Name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("goal", T.StringType()),
        T.StructField("actions", T.ArrayType(T.StringType())),
        T.StructField("kpis", T.ArrayType(T.StringType())),
    ]
)


def segment_dimension(spark: SparkSession, rows=None) -> DataFrame:
    """One row per named segment; ``rows`` replaces the default four."""
    return spark.createDataFrame(SEGMENTS if rows is None else rows, SEGMENT_SCHEMA)


def _names(dim: DataFrame) -> DataFrame:
    """Id and name of each segment. The planner decides by its size whether to broadcast it."""
    return dim.select("Cluster", "Segment_Name")


def with_segment_name(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Profile form of the lookup: a cluster without a name gets NULL."""
    return df.join(_names(dim), "Cluster", "left")


def with_segment_label(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Scoring form of the lookup: a cluster without a name is called ``Cluster_<id>``."""
    named = with_segment_name(df, dim)
    fallback = F.concat(F.lit("Cluster_"), F.col("Cluster").cast("string"))
    return named.withColumn("Segment_Name", F.coalesce("Segment_Name", fallback))


def cluster_of_name(names: DataFrame, dim: DataFrame) -> DataFrame:
    """Reverse lookup on ``Segment_Name``; an unknown name gets a NULL id."""
    return names.join(_names(dim), "Segment_Name", "left")


def cluster_distribution(clustered: DataFrame) -> DataFrame:
    """Count and share of all rows per cluster id.

    The total is a window over the grouped rows, one per cluster, not over the customers.
    """
    counts = clustered.groupBy("Cluster").agg(F.count(F.lit(1)).alias("count"))
    whole = Window.partitionBy()
    return counts.withColumn("percentage", fx.percent(F.col("count"), F.sum("count").over(whole)))


def segment_info(clustered: DataFrame, dim: DataFrame, segment_id: int | None = None) -> DataFrame:
    """Size, share and mean recency, frequency and monetary value per cluster present.

    With an id only that cluster, also one that no row belongs to: size 0 and no means.
    """
    whole = Window.partitionBy()
    stats = (
        clustered.groupBy("Cluster")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.avg("Recency").alias("avg_recency"),
            F.avg("Frequency").alias("avg_frequency"),
            F.avg("Monetary").alias("avg_monetary"),
        )
        .withColumn("percentage", fx.percent(F.col("size"), F.sum("size").over(whole)))
    )
    if segment_id is not None:
        asked = clustered.sparkSession.createDataFrame([(segment_id,)], "Cluster int")
        stats = (
            asked.join(stats, "Cluster", "left")
            .withColumn("size", F.coalesce("size", F.lit(0)))
            .withColumn("percentage", F.coalesce("percentage", F.lit(0.0)))
        )
    described = with_segment_label(stats, dim).join(
        dim.select("Cluster", "description"), "Cluster", "left"
    )
    return described.select(
        F.col("Cluster").alias("segment_id"),
        F.col("Segment_Name").alias("segment_name"),
        F.coalesce("description", F.lit(NO_DESCRIPTION)).alias("description"),
        "size",
        "percentage",
        "avg_recency",
        "avg_frequency",
        "avg_monetary",
    )


def segment_info_without_data(dim: DataFrame, segment_id: int | None = None) -> DataFrame:
    """Names and descriptions only, for when no clustered table exists yet."""
    if segment_id is not None:
        asked = dim.sparkSession.createDataFrame([(segment_id,)], "Cluster int")
        dim = asked.join(dim, "Cluster", "left")
    label = F.coalesce("Segment_Name", F.concat(F.lit("Cluster_"), F.col("Cluster").cast("string")))
    empty = F.lit(None).cast("double")
    return dim.select(
        F.col("Cluster").alias("segment_id"),
        label.alias("segment_name"),
        F.coalesce("description", F.lit(NO_DESCRIPTION)).alias("description"),
        F.lit(None).cast("long").alias("size"),
        *[empty.alias(c) for c in ("percentage", "avg_recency", "avg_frequency", "avg_monetary")],
    )
