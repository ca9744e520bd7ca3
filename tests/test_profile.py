import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallybasket.operators import profile, segments

METRICS = ["Recency", "Frequency", "Monetary", "AvgTransactionValue", "CustomerLifetime", "PurchaseFrequency", "TotalTransactions"]


@pytest.fixture(scope="module")
def frame():
    """Uneven clusters, skewed spend, and many ties among days and counts."""
    rng = np.random.default_rng(7)
    n = 137
    spend = rng.lognormal(5, 1.5, n).round(1)
    visits = rng.geometric(0.3, n)
    return pd.DataFrame(
        {
            "CustomerID": 1000 + 3 * np.arange(n),
            "Cluster": rng.choice(4, n, p=[0.15, 0.55, 0.2, 0.1]).astype("int32"),
            "Recency": 7 * rng.integers(0, 40, n),
            "Frequency": visits,
            "Monetary": spend,
            "AvgTransactionValue": spend / visits,
            "CustomerLifetime": 30 * rng.integers(0, 9, n) + 1,
            "PurchaseFrequency": rng.choice([0.5, 1.0, 2.0], n),
            "TotalTransactions": visits + rng.poisson(4, n),
        }
    )


@pytest.fixture(scope="module")
def clustered(spark, frame):
    return spark.createDataFrame(frame).withColumn("Cluster", F.col("Cluster").cast("int"))


@pytest.fixture(scope="module")
def dim(spark):
    return segments.segment_dimension(spark)


def test_names_and_reverse_lookup(spark, dim):
    rows = spark.createDataFrame([(0,), (3,), (4,)], "Cluster int")
    assert [r["Segment_Name"] for r in segments.with_segment_name(rows, dim).orderBy("Cluster").collect()] == [
        "VIP Customers", "At Risk Customers", None,
    ]
    assert segments.with_segment_label(rows, dim).where("Cluster = 4").first()["Segment_Name"] == "Cluster_4"
    names = spark.createDataFrame([("Regular Loyalists",), ("Nobody",)], "Segment_Name string")
    assert {r["Segment_Name"]: r["Cluster"] for r in segments.cluster_of_name(names, dim).collect()} == {
        "Regular Loyalists": 2, "Nobody": None,
    }


def test_distribution_counts_everyone(clustered, dim, frame):
    rows = profile.segment_distribution(clustered, dim).collect()
    assert sum(r["count"] for r in rows) == len(frame) == rows[0]["total_customers"]
    assert abs(sum(r["percentage"] for r in rows) - 100) < 1e-9
    assert [r["count"] for r in rows] == sorted((r["count"] for r in rows), reverse=True)


def test_unnamed_clusters_count_in_the_total_only(spark, dim):
    rows = spark.createDataFrame([(1, 0, 5.0), (2, 4, 5.0), (3, 4, 90.0), (4, 1, 5.0)], "CustomerID long, Cluster int, Monetary double")
    got = {r["Segment_Name"]: r for r in profile.segment_distribution(rows, dim).collect()}
    assert set(got) == {"VIP Customers", "Occasional Shoppers"} and got["VIP Customers"]["percentage"] == 25.0
    money = {r["Segment_Name"]: r for r in profile.revenue_contribution(rows, dim).collect()}
    assert money["VIP Customers"]["Revenue_Percentage"] == 50.0 and money["VIP Customers"]["Customer_Percentage"] == 25.0


def test_characteristics_match_pandas(clustered, dim, frame):
    got = {(r["Segment_Name"], r["metric"]): r for r in profile.segment_characteristics(clustered, dim).collect()}
    names = {row[0]: row[1] for row in segments.SEGMENTS}
    assert len(got) == 4 * len(METRICS)
    for cluster, part in frame.groupby("Cluster"):
        for metric in METRICS:
            row, s = got[(names[cluster], metric)], part[metric]
            expected = [s.mean(), s.median(), s.std(), s.min(), s.max(), s.quantile(0.25), s.quantile(0.75)]
            assert np.allclose([row[c] for c in ("mean", "median", "std", "min", "max", "q25", "q75")], expected)
            assert row["min"] <= row["mean"] and row["median"] <= row["max"] and row["size"] == len(part)


def test_empty_segment_keeps_its_row(clustered, dim):
    part = clustered.where("Cluster <> 3").drop("TotalTransactions")
    rows = [r for r in profile.segment_characteristics(part, dim).collect() if r["Segment_Name"] == "At Risk Customers"]
    assert len(rows) == len(METRICS) - 1 and {r["size"] for r in rows} == {0} and {r["mean"] for r in rows} == {None}
    advice = {r["Segment_Name"]: r for r in profile.recommendations(part, dim).collect()}
    assert advice["At Risk Customers"]["size"] == 0 and advice["At Risk Customers"]["avg_recency"] is None
    assert len(advice["VIP Customers"]["actions"]) == 4 and len(advice["VIP Customers"]["success_metrics"]) == 3


def test_revenue_sums(clustered, dim, frame):
    rows = profile.revenue_contribution(clustered, dim).collect()
    assert abs(sum(r["Total_Revenue"] for r in rows) - frame["Monetary"].sum()) < 1e-6
    assert abs(sum(r["Revenue_Percentage"] for r in rows) - 100) < 0.05
    assert max(r["Revenue_per_Customer_Percentile"] for r in rows) == 100.0


def test_summary_from_given_analyses(spark):
    distribution = spark.createDataFrame(
        [("North", 3, 36, 9.0, "", 400), ("East", 1, 124, 31.0, "", 400), ("West", 2, 240, 60.0, "", 400)],
        "Segment_Name string, cluster_id int, count long, percentage double, description string, total_customers long",
    )
    revenue = spark.createDataFrame(
        [("North", 81_250.0, 2256.94, 65.0), ("East", 31_250.0, 252.02, 25.0), ("West", 12_500.0, 52.08, 10.0)],
        "Segment_Name string, Total_Revenue double, Avg_Revenue_per_Customer double, Revenue_Percentage double",
    )
    row = profile.executive_summary(distribution, revenue, dt.date(2025, 10, 31)).first()
    assert (row["date"], row["total_customers"], row["segments_identified"]) == ("2025-10-31", 400, 3)
    assert row["key_findings"][1:] == ["Largest segment: West (60.0% of customers)", "Smallest segment: North (9.0% of customers)"]
    assert row["business_impact"] == [
        "Revenue concentration: North contributes 65.0% of total revenue",
        "Customer value range: $252.02 to $52.08 per customer",
    ]
    assert (row["least_mean_revenue"], row["greatest_mean_revenue"]) == (52.08, 2256.94)


def test_equal_sizes_are_decided_by_name(spark, dim):
    rows = spark.createDataFrame([(1, 0, 5.0), (2, 1, 5.0)], "CustomerID long, Cluster int, Monetary double")
    distribution, revenue = profile.segment_distribution(rows, dim), profile.revenue_contribution(rows, dim)
    findings = profile.executive_summary(distribution, revenue, dt.date(2024, 1, 1)).first()["key_findings"]
    assert all("Occasional Shoppers" in line for line in findings[1:])


def test_box_plot_matches_whisker_rule(clustered, frame):
    got = {(r["Cluster"], r["metric"]): r for r in profile.box_plot(clustered).collect()}
    for cluster, part in frame.groupby("Cluster"):
        s = part["Monetary"]
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        inside = s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))]
        row = got[(cluster, "Monetary")]
        assert np.allclose([row["whisker_low"], row["whisker_high"]], [inside.min(), inside.max()])
        assert row["n_outside"] == len(s) - len(inside)


def test_report_parses(clustered, dim):
    row = profile.full_report(clustered, dim, dt.date(2024, 1, 1)).select(F.to_json(F.struct("*")).alias("j")).first()
    report = json.loads(row["j"])
    assert set(report) == {"distribution", "characteristics", "revenue", "recommendations", "executive_summary"}
    assert report["distribution"]["total_customers"] == 137
    assert set(report["characteristics"]["VIP Customers"]["metrics"]) == set(METRICS)
    summary, advice = report["executive_summary"], report["recommendations"]["VIP Customers"]
    assert set(summary["project_overview"]) == {"title", "date", "total_customers", "segments_identified"}
    assert {"key_findings", "business_impact", "recommendations", "next_steps"} <= set(summary) and "date" not in summary
    assert set(advice["business_actions"]) == {"goal", "actions", "kpis"} and "avg_monetary" in advice["key_characteristics"]


def test_fixed_lines_stay_without_customers(clustered, dim):
    none = clustered.where("false")
    lines = profile.insight_lines(profile.segment_distribution(none, dim), profile.revenue_contribution(none, dim)).collect()
    assert [(r["section"], r["line"]) for r in lines] == [("recommendations", i) for i in (1, 2, 3)]


def test_segment_info_unknown_and_without_data(clustered, dim):
    row = segments.segment_info(clustered, dim, 9).first()
    assert (row["segment_name"], row["size"], row["percentage"], row["avg_recency"]) == ("Cluster_9", 0, 0.0, None)
    assert row["description"] == segments.NO_DESCRIPTION
    assert segments.segment_info_without_data(dim).count() == 4
    assert segments.segment_info_without_data(dim, 9).first()["segment_name"] == "Cluster_9"
