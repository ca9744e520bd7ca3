"""Profiles of named segments: distribution, metric statistics, revenue, actions, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybasket.functions import columns as fx
from tallybasket.operators.quantiles import exact_quantiles, unpivot_metrics
from tallybasket.operators.segments import cluster_of_name, with_segment_name
from tallybasket.schemas import PROFILE_METRICS
from tallybasket.session import materialize

BOX_METRICS = [m for m in PROFILE_METRICS if m != "TotalTransactions"]
WHISKER_WIDTH = 1.5

# Texts of the recommendations and the summary.
SUCCESS_METRICS = [
    "Increase segment retention by 15%",
    "Improve segment revenue contribution by 10%",
    "Reduce segment churn rate by 20%",
]
SUMMARY_TITLE = "Customer Segmentation Analysis"
SUMMARY_RECOMMENDATIONS = [
    "1. Focus retention efforts on highest-value segments",
    "2. Implement segment-specific marketing campaigns",
    "3. Develop targeted win-back strategies for at-risk segments",
    "4. Create personalized customer journeys for each segment",
]
SUMMARY_NEXT_STEPS = [
    "1. Implement recommendations in marketing automation",
    "2. Set up ongoing segment monitoring",
    "3. Quarterly review and model retraining",
    "4. A/B test segment-specific strategies",
]


def all_segments():
    """Window over a whole table; used on grouped rows only, one per segment."""
    return Window.partitionBy()


def text_array(texts: Sequence[str]) -> Column:
    return F.array(*[F.lit(x) for x in texts])


def segment_distribution(clustered: DataFrame, dim: DataFrame) -> DataFrame:
    """Count and share per named segment, largest first; unnamed rows count in the total only."""
    counts = clustered.groupBy("Cluster").agg(F.count(F.lit(1)).alias("count"))
    named = with_segment_name(counts, dim).withColumn("total_customers", F.sum("count").over(all_segments()))
    by_name = (
        named.where(F.col("Segment_Name").isNotNull())
        .groupBy("Segment_Name")
        .agg(F.sum("count").alias("count"), F.max("total_customers").alias("total_customers"))
    )
    return (
        cluster_of_name(by_name, dim)
        .join(dim.select("Cluster", "description"), "Cluster", "left")
        .select(
            "Segment_Name",
            F.col("Cluster").alias("cluster_id"),
            "count",
            fx.percent(F.col("count"), F.col("total_customers")).alias("percentage"),
            "description",
            "total_customers",
        )
        .orderBy(F.desc("count"), "Segment_Name")
    )


def segment_sizes(clustered: DataFrame, dim: DataFrame) -> DataFrame:
    """Size and share of every segment of the dimension, empty ones included."""
    counts = clustered.groupBy("Cluster").agg(F.count(F.lit(1)).alias("size"))
    counts = counts.withColumn("_total", F.sum("size").over(all_segments()))
    full = dim.select("Cluster", "Segment_Name").join(counts, "Cluster", "left")
    total = F.max("_total").over(all_segments())
    size = F.coalesce(F.col("size"), F.lit(0))
    return full.select("Cluster", "Segment_Name", size.alias("size"), F.coalesce(fx.percent(size, total), F.lit(0.0)).alias("percentage"))


def segment_characteristics(
    clustered: DataFrame, dim: DataFrame, metrics: Sequence[str] = tuple(PROFILE_METRICS)
) -> DataFrame:
    """Mean, median, sample deviation, minimum, maximum and quartiles per segment and metric.

    Metrics the table lacks are left out. A segment without rows keeps its size of 0.
    """
    metrics = [m for m in metrics if m in clustered.columns]
    sizes = segment_sizes(clustered, dim)
    wide = clustered.groupBy("Cluster").agg(
        *[
            F.struct(
                F.avg(m).alias("mean"),
                F.stddev_samp(m).alias("std"),
                F.min(m).cast("double").alias("min"),
                F.max(m).cast("double").alias("max"),
            ).alias(m)
            for m in metrics
        ]
    )
    moments = wide.select(
        "Cluster",
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), *[F.col(m)[s].alias(s) for s in ("mean", "std", "min", "max")]) for m in metrics])),
    )
    quartiles = exact_quantiles(clustered, metrics, [0.25, 0.5, 0.75], by=["Cluster"])
    stats = moments.join(quartiles, ["Cluster", "metric"], "left")
    every = sizes.withColumn("metric", F.explode(text_array(metrics)))
    return every.join(stats, ["Cluster", "metric"], "left").select(
        "Segment_Name",
        "size",
        "percentage",
        "metric",
        "mean",
        F.col("q")[1].alias("median"),
        "std",
        "min",
        "max",
        F.col("q")[0].alias("q25"),
        F.col("q")[2].alias("q75"),
    )


def revenue_contribution(clustered: DataFrame, dim: DataFrame) -> DataFrame:
    """Revenue per named segment: shares of named revenue and of all customers, rounded half even."""
    named = with_segment_name(clustered, dim)
    groups = named.groupBy("Segment_Name").agg(
        fx.sum_or_zero(F.col("Monetary")).alias("Total_Revenue"),
        F.avg("Monetary").alias("Avg_Revenue_per_Customer"),
        F.count("Monetary").alias("Customer_Count"),
        F.count(F.lit(1)).alias("_rows"),
    )
    groups = groups.withColumn("_all", F.sum("_rows").over(all_segments())).where(F.col("Segment_Name").isNotNull())
    medians = exact_quantiles(named.where(F.col("Segment_Name").isNotNull()), ["Monetary"], [0.5], by=["Segment_Name"])
    joined = groups.join(medians.select("Segment_Name", F.col("q")[0].alias("Median_Revenue_per_Customer")), "Segment_Name", "left")
    total = F.sum("Total_Revenue").over(all_segments())
    best = F.max("Avg_Revenue_per_Customer").over(all_segments())
    return joined.select(
        "Segment_Name",
        "Total_Revenue",
        "Avg_Revenue_per_Customer",
        "Median_Revenue_per_Customer",
        "Customer_Count",
        fx.half_even(fx.percent(F.col("Total_Revenue"), total)).alias("Revenue_Percentage"),
        fx.half_even(fx.percent(F.col("Customer_Count"), F.col("_all"))).alias("Customer_Percentage"),
        fx.half_even(fx.percent(F.col("Avg_Revenue_per_Customer"), best)).alias("Revenue_per_Customer_Percentile"),
    )


def recommendations(clustered: DataFrame, dim: DataFrame) -> DataFrame:
    """Per segment of the dimension: size, key means, goal, actions, indicators and targets."""
    means = {"Recency": "avg_recency", "Frequency": "avg_frequency", "Monetary": "avg_monetary"}
    aggregates = [F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(name) for c, name in means.items()]]
    lifetime = F.lit(None).cast("double")
    if "CustomerLifetime" in clustered.columns:
        aggregates.append(F.avg("CustomerLifetime").alias("customer_lifetime"))
        lifetime = F.col("customer_lifetime")
    stats = clustered.groupBy("Cluster").agg(*aggregates)
    return dim.join(stats, "Cluster", "left").select(
        "Segment_Name",
        "description",
        F.coalesce("size", F.lit(0)).alias("size"),
        *means.values(),
        lifetime.alias("customer_lifetime"),
        "goal",
        "actions",
        "kpis",
        text_array(SUCCESS_METRICS).alias("success_metrics"),
    )


def executive_summary(distribution: DataFrame, revenue: DataFrame, date: dt.date | Column | None = None) -> DataFrame:
    """One row of key findings. Equal counts are decided by the segment name.

    ``value_range`` runs from the first to the last segment by name; the true least and
    greatest mean stand beside it.
    """
    if date is None:
        date = F.current_date()
    elif not isinstance(date, Column):
        date = F.lit(date)
    name, share = F.col("Segment_Name"), F.col("percentage")
    found = distribution.agg(
        F.max("total_customers").alias("total_customers"),
        F.count(F.lit(1)).alias("segments_identified"),
        F.min(F.struct((-F.col("count")).alias("c"), name.alias("name"), share.alias("share"))).alias("largest"),
        F.min(F.struct(F.col("count").alias("c"), name.alias("name"), share.alias("share"))).alias("smallest"),
    )
    mean = F.col("Avg_Revenue_per_Customer")
    money = revenue.agg(
        F.min(F.struct((-F.col("Total_Revenue")).alias("r"), name.alias("name"), F.col("Revenue_Percentage").alias("share"))).alias("top"),
        F.min_by(mean, name).alias("first_mean"),
        F.max_by(mean, name).alias("last_mean"),
        F.min(mean).alias("least_mean"),
        F.max(mean).alias("greatest_mean"),
    )
    m = money.select(F.struct("*")).scalar()
    # The wording of the findings and of the impact.
    return found.select(
        F.lit(SUMMARY_TITLE).alias("title"),
        F.date_format(date, "yyyy-MM-dd").alias("date"),
        F.coalesce("total_customers", F.lit(0)).alias("total_customers"),
        "segments_identified",
        F.array(
            F.format_string("Identified %d distinct customer segments", F.col("segments_identified")),
            F.format_string("Largest segment: %s (%.1f%% of customers)", F.col("largest.name"), F.col("largest.share")),
            F.format_string("Smallest segment: %s (%.1f%% of customers)", F.col("smallest.name"), F.col("smallest.share")),
        ).alias("key_findings"),
        F.array(
            F.format_string(
                "Revenue concentration: %s contributes %.1f%% of total revenue", m["top"]["name"], m["top"]["share"]
            ),
            F.format_string("Customer value range: $%.2f to $%.2f per customer", m["first_mean"], m["last_mean"]),
        ).alias("business_impact"),
        m["least_mean"].alias("least_mean_revenue"),
        m["greatest_mean"].alias("greatest_mean_revenue"),
        text_array(SUMMARY_RECOMMENDATIONS).alias("recommendations"),
        text_array(SUMMARY_NEXT_STEPS).alias("next_steps"),
    )


def insight_lines(distribution: DataFrame, revenue: DataFrame) -> DataFrame:
    """The report's short text as (section, line, text)."""
    sizes = distribution.select(
        F.lit("distribution").alias("section"),
        F.row_number().over(Window.orderBy(F.desc("count"), "Segment_Name")).alias("line"),
        F.format_string("%s: %d customers (%s%%)", "Segment_Name", "count", fx.one_decimal(F.col("percentage"))).alias("text"),
    )
    money = revenue.select(
        F.lit("revenue").alias("section"),
        F.row_number().over(Window.orderBy("Segment_Name")).alias("line"),
        F.format_string(
            "%s: $%s (%s%% of total)",
            "Segment_Name",
            fx.whole_dollars(F.col("Total_Revenue")),
            fx.one_decimal(F.col("Revenue_Percentage")),
        ).alias("text"),
    )
    lines = [("recommendations", i, text) for i, text in enumerate(SUMMARY_RECOMMENDATIONS[:3], 1)]
    fixed = distribution.sparkSession.createDataFrame(lines, "section string, line int, text string")
    return sizes.unionByName(money).unionByName(fixed)


def box_plot(clustered: DataFrame, metrics: Sequence[str] = tuple(BOX_METRICS)) -> DataFrame:
    """Quartiles, whisker ends and the number of values beyond them, per cluster and metric."""
    metrics = [m for m in metrics if m in clustered.columns]
    boxes = materialize(exact_quantiles(clustered, metrics, [0.25, 0.5, 0.75], by=["Cluster"]), "boxes")
    q1, q3 = F.col("q")[0], F.col("q")[2]
    reach = WHISKER_WIDTH * (q3 - q1)
    boxes = boxes.withColumns({"_low": q1 - reach, "_high": q3 + reach})
    values = unpivot_metrics(clustered, ["Cluster"], metrics).where(F.col("value").isNotNull())
    inside = (F.col("value") >= F.col("_low")) & (F.col("value") <= F.col("_high"))
    ends = (
        values.join(boxes.select("Cluster", "metric", "_low", "_high"), ["Cluster", "metric"])
        .groupBy("Cluster", "metric")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outside"),
        )
    )
    return boxes.join(ends, ["Cluster", "metric"]).select(
        "Cluster",
        "metric",
        "n",
        q1.alias("q1"),
        F.col("q")[1].alias("median"),
        q3.alias("q3"),
        F.least("whisker_low", q1).alias("whisker_low"),
        F.greatest("whisker_high", q3).alias("whisker_high"),
        "n_outside",
    )


def distribution_chart(distribution: DataFrame) -> DataFrame:
    """Bar chart rows: one bar per segment with its label."""
    label = F.format_string("%d\n(%s%%)", "count", fx.one_decimal(F.col("percentage")))
    return distribution.select("Segment_Name", "count", "percentage", label.alias("label"))


def revenue_charts(revenue: DataFrame) -> DataFrame:
    """Rows of the revenue share chart and of the count-against-revenue chart."""
    return revenue.select(
        "Segment_Name",
        "Revenue_Percentage",
        "Customer_Count",
        "Total_Revenue",
        (F.col("Avg_Revenue_per_Customer") / 10).alias("marker_size"),
    )


def nested(df: DataFrame, key: str) -> Column:
    """All rows of a small table as one map from ``key`` to the other columns."""
    rest = F.struct(*[F.col(c) for c in df.columns if c != key])
    entries = F.collect_list(F.struct(F.col(key).alias("k"), rest.alias("v")))
    return df.agg(F.map_from_entries(F.array_sort(entries, _by_key))).scalar()


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)


def nested_summary(summary: DataFrame) -> DataFrame:
    """The summary's row as it stands in a report: the overview apart from findings, impact and advice."""
    overview = ["title", "date", "total_customers", "segments_identified"]
    return summary.select(F.struct(*overview).alias("project_overview"), *[c for c in summary.columns if c not in overview])


def nested_recommendations(rows: DataFrame) -> DataFrame:
    """Recommendations as they stand in a report; a segment without customers has no characteristics."""
    means = F.struct("avg_recency", "avg_frequency", "avg_monetary", "customer_lifetime")
    return rows.select(
        "Segment_Name",
        "description",
        "size",
        F.when(F.col("size") > 0, means).alias("key_characteristics"),
        F.struct("goal", "actions", "kpis").alias("business_actions"),
        "success_metrics",
    )


def full_report(clustered: DataFrame, dim: DataFrame, date: dt.date | None = None) -> DataFrame:
    """All analyses as one row of nested values. Each part holds a few rows per segment."""
    distribution = materialize(segment_distribution(clustered, dim), "distribution")
    revenue = materialize(revenue_contribution(clustered, dim), "revenue")
    stats = segment_characteristics(clustered, dim)
    by_segment = stats.groupBy("Segment_Name").agg(
        F.max("size").alias("size"),
        F.max("percentage").alias("percentage"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("metric", F.struct("mean", "median", "std", "min", "max", "q25", "q75"))))
        ).alias("metrics"),
    )
    summary = nested_summary(executive_summary(distribution, revenue, date))
    return summary.select(
        F.struct(
            F.col("project_overview.total_customers").alias("total_customers"),
            nested(distribution.drop("total_customers"), "Segment_Name").alias("segments"),
        ).alias("distribution"),
        nested(by_segment, "Segment_Name").alias("characteristics"),
        nested(revenue, "Segment_Name").alias("revenue"),
        nested(nested_recommendations(recommendations(clustered, dim)), "Segment_Name").alias("recommendations"),
        F.struct(*summary.columns).alias("executive_summary"),
    )
