"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from checks import tables as t
from tallybasket.operators import cleaning, features, metrics, profile, segments
from tallybasket.operators.quantiles import exact_quantiles
from tallybasket.session import materialize
from tallybasket.sources import transactions

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    raw = t.tx(spark, SF, described=True)
    raw.write.parquet(str(tmp_path / "raw"))
    text = plan(features.rfm_features(cleaning.clean_transactions(spark.read.parquet(str(tmp_path / "raw")))))
    assert "IsNotNull(CustomerID)" in text and "GreaterThan(Quantity,0)" in text
    reads = re.findall(r"ReadSchema: (\S+)", text)
    assert reads and not any("Description" in r or "StockCode" in r for r in reads)


def test_features_take_one_grouping_and_no_join(spark, tmp_path):
    clean = materialize(t.clean(spark, SF), "clean")
    text = plan(features.customer_features(clean))
    assert "Join" not in text
    # One shuffle by (customer, value) for the distinct counts, one by customer, one for the reference date.
    assert text.count("Exchange") <= 4


def test_cleaning_is_map_only(spark):
    clean = cleaning.clean_transactions(spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("user_id").alias("CustomerID"), F.lit(1).alias("Quantity"), F.col("value").alias("UnitPrice"),
        F.col("ts").cast("timestamp").alias("InvoiceDate")))
    assert "Exchange" not in plan(clean)


@pytest.mark.parametrize("name", ["quantiles", "characteristics", "revenue", "davies_bouldin", "outliers", "labels"])
def test_no_cross_joins(spark, name):
    rows = materialize(t.clustered(spark, SF), "clustered")
    dim = segments.segment_dimension(spark)
    cols = ["Recency", "Frequency", "Monetary"]
    made = {
        "quantiles": lambda: exact_quantiles(rows, ["Monetary"], [0.5], by=["Cluster"]),
        "characteristics": lambda: profile.segment_characteristics(rows, dim),
        "revenue": lambda: profile.revenue_contribution(rows, dim),
        "davies_bouldin": lambda: metrics.davies_bouldin(rows, "Cluster", cols),
        "outliers": lambda: cleaning.flag_outliers(rows.withColumn("Amount", F.col("Monetary"))),
        "labels": lambda: segments.with_segment_label(rows, dim),
    }
    text = plan(made[name]())
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_large_sides_are_not_broadcast(spark):
    """Beyond the threshold the quantile brackets are joined by a shuffle."""
    rows = materialize(t.clustered(spark, SF), "clustered")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        got = exact_quantiles(rows, ["Monetary"], [0.5], by=["Cluster"])
        assert "BroadcastHashJoin" not in plan(got) and got.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_range_of_months_reads_its_folders_only(spark, tmp_path):
    path = transactions.write_clean_table(t.clean(spark, SF), str(tmp_path / "months"))
    some = transactions.read_parquet_table(spark, path).where(F.col("YearMonth").between("1996-01", "1997-12"))
    assert "PartitionFilters: [isnotnull(YearMonth" in plan(some) and 0 < some.count() < t.clean(spark, SF).count()


def test_a_month_is_written_by_as_many_tasks_as_its_rows_need(spark, tmp_path, monkeypatch):
    """One large and one small month, and rows without a date, with AQE not merging small partitions."""
    monkeypatch.setattr(transactions, "MONTH_ROWS", 100)
    months = F.when(F.col("id") < 2000, "2024-01").when(F.col("id") < 2050, "2024-02")
    rows = spark.range(2060).select(F.col("id").alias("CustomerID"), F.col("id").cast("string").alias("InvoiceNo"), months.alias("YearMonth"))
    path = transactions.write_clean_table(rows, str(tmp_path / "months"))
    assert transactions.read_parquet_table(spark, path).count() == 2060
    files = {m: len(list((tmp_path / "months" / f"YearMonth={m}").glob("*.parquet"))) for m in ("2024-01", "2024-02")}
    assert files["2024-02"] == 1 and files["2024-01"] >= 1


def test_silhouette_sends_blocks_along_rows_and_columns_only(spark):
    """400 points in 4 x 4 squares: a point is sent four times each way, not once for each other block; sums come folded."""
    points = spark.range(400).select(F.col("id").alias("CustomerID"), F.rand(1).alias("x"), F.rand(2).alias("y"), (F.col("id") % 3).alias("c"))
    points = materialize(points, "points")
    sides = metrics._sides(points, ["c"], ["x", "y"], side_points=100, block_rows=10)
    for side in (sides.rows, sides.columns):
        assert side.select(F.sum(F.size("w"))).first()[0] == 400 * 4
    sums = metrics._distance_sums(sides, 1)
    assert sums.where("c IS NULL").count() == 400 * 4
    # Three clusters that go on in all four columns: for each point the two others, once per column.
    assert sums.where("c IS NOT NULL").count() == 400 * 4 * 2


def test_small_clusters_stay_in_one_column(spark):
    """A cluster for every two points: no sum leaves its square, however many clusters there are."""
    points = spark.range(400).select(F.col("id").alias("CustomerID"), F.rand(1).alias("x"), F.rand(2).alias("y"), F.floor(F.col("id") / 2).alias("c"))
    points = materialize(points, "points")
    sums = metrics._distance_sums(metrics._sides(points, ["c"], ["x", "y"], side_points=100, block_rows=10), 1)
    assert sums.where("c IS NOT NULL").count() == 0
    whole = metrics.silhouettes(points, ["c"], ["x", "y"]).first()["silhouette"]
    assert abs(metrics.silhouettes(points, ["c"], ["x", "y"], side_points=60, block_rows=7).first()["silhouette"] - whole) < 1e-12


def test_nine_labellings_take_two_scans(spark, monkeypatch):
    points = spark.range(200).select(F.rand(1).alias("x"), F.rand(2).alias("y"), *[(F.col("id") % k).alias(f"k{k}") for k in range(2, 11)])
    points, seen, write = materialize(points, "labelled-points"), [], metrics.materialize

    def scans(df):
        return len(re.findall(r"Relation \[x#\d+,y#\d+,k2#", df._jdf.queryExecution().optimizedPlan().toString()))

    def counted(df, name):
        seen.append(scans(df))
        return write(df, name)

    monkeypatch.setattr(metrics, "materialize", counted)
    got = metrics.measures(points, [f"k{k}" for k in range(2, 11)], ["x", "y"])
    assert got.count() == 9 and sum(seen) + scans(got) == 2
