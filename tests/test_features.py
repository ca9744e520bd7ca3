import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybasket.functions import columns as fx
from tallybasket.operators import features, preparation
from tallybasket.sources.transactions import example_transactions

SCHEMA = "CustomerID long, InvoiceNo string, StockCode string, Quantity int, InvoiceDate timestamp, Amount double"


def ts(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


@pytest.fixture(scope="module")
def clean(spark):
    rows = [
        (1, "a", "x", 1, ts(1, 23), 10.0),
        (1, "a", "y", 2, ts(1, 23), 20.0),
        (1, "b", "x", 3, ts(3, 1), 30.0),
        (2, "c", "x", 4, ts(2, 9), 0.0),
        (2, "c", "x", 1, ts(2, 17), 0.0),
        (3, "d", "z", 5, ts(5, 1), 7.5),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def by_customer(df):
    return {r["CustomerID"]: r for r in df.collect()}


def test_recency_counts_whole_days(clean):
    got = by_customer(features.rfm_features(clean))
    # Reference: the 6th at 01:00. Customer 1 bought last on the 3rd at 01:00.
    assert [got[c]["Recency"] for c in (1, 2, 3)] == [3, 3, 1]
    assert [got[c]["Frequency"] for c in (1, 2, 3)] == [2, 1, 1]
    assert [got[c]["Monetary"] for c in (1, 2, 3)] == [60.0, 0.0, 7.5]


def test_given_reference_date_is_used_each_time(clean):
    first = by_customer(features.rfm_features(clean, dt.datetime(2024, 1, 10)))
    second = by_customer(features.rfm_features(clean.where("CustomerID = 1"), dt.datetime(2024, 1, 20)))
    assert first[1]["Recency"] == 6 and second[1]["Recency"] == 16


def test_day_difference_rounds_down_below_zero(spark):
    row = spark.createDataFrame([(ts(1, 23), ts(3, 1))], "a timestamp, b timestamp").select(
        fx.whole_days(F.col("b"), F.col("a")).alias("up"), fx.whole_days(F.col("a"), F.col("b")).alias("down")
    ).first()
    assert (row["up"], row["down"]) == (1, -2)


def test_behaviour_counts_timestamps_and_one_row_deviation(clean):
    got = by_customer(features.behavioural_features(clean))
    assert [got[c]["UniquePurchaseDays"] for c in (1, 2, 3)] == [2, 2, 1]
    assert got[3]["StdTransactionValue"] is None
    assert got[1]["CustomerLifetime"] == 2
    assert got[1]["PurchaseFrequency"] == 1.5 and got[1]["AvgBasketSize"] == 2.0
    assert math.isclose(got[1]["ProductVariety"], 2 / 3)


def test_join_and_single_grouping_agree(clean):
    joined = features.join_features(features.rfm_features(clean), features.behavioural_features(clean))
    whole = features.customer_features(clean)
    assert sorted(map(tuple, joined.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_missing_amounts_sum_to_zero(spark):
    rows = spark.createDataFrame([(9, "a", "x", 1, ts(1), None)], SCHEMA)
    row = features.customer_features(rows).first()
    assert row["Monetary"] == 0.0 and row["TotalTransactions"] == 0 and row["PurchaseFrequency"] == 0.0
    assert row["AvgBasketSize"] is None


def test_scoring_differs_from_training(clean):
    got = by_customer(features.scoring_features(clean, dt.datetime(2024, 1, 10)))
    assert got[1]["Frequency"] == 3 and got[2]["PurchaseFrequency"] == 2.0
    assert got[2]["Recency"] == 7
    assert 2 in got and got[2]["Monetary"] == 0.0


def test_zero_spend_customers_leave_before_clustering(clean):
    full = features.customer_features(clean)
    row = preparation.spend_audit(full).first()
    assert (row["customers"], row["kept"], row["dropped_zero_spend"]) == (3, 2, 1)
    matrix = preparation.unscaled_matrix(full)
    assert matrix.columns[1:] == [
        "Recency", "Log_Frequency", "Log_Monetary", "Log_AvgTransactionValue", "CustomerLifetime", "PurchaseFrequency",
    ]
    assert sorted(r["CustomerID"] for r in matrix.collect()) == [1, 3]


def test_medians_fill_gaps(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 4.0), (3, None), (4, 7.0), (5, 8.0)], "CustomerID long, v double")
    got = by_customer(preparation.fill_with_medians(df, ["v"]))
    assert got[3]["v"] == 5.5
    assert preparation.missing_values(df, ["v"]).first()["missing_total"] == 1


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    values = [1.0, 2.0, 6.0, 9.0]
    df = spark.createDataFrame([(i, v, 3.0) for i, v in enumerate(values)], "CustomerID long, a double, b double")
    scaler = preparation.Scaler.from_table(preparation.scaler_parameters(df, ["a", "b"]))
    assert np.allclose(scaler.scales, [np.std(values), 1.0])
    got = preparation.scale_features(df, scaler).orderBy("CustomerID").collect()
    assert np.allclose([r["a"] for r in got], (np.array(values) - 4.5) / np.std(values))
    assert {r["b"] for r in got} == {0.0}


def test_absent_features_become_zero_before_scaling(spark):
    df = spark.createDataFrame([(1, 5.0, 9.0)], "CustomerID long, a double, extra double")
    assert preparation.align_to_model(df, ["b", "a"]).columns == ["CustomerID", "b", "a"]
    assert preparation.align_to_model(df, ["b", "a"]).first()["b"] == 0.0


def test_example_rows_score(spark):
    rows = example_transactions(spark).withColumn("InvoiceDate", fx.parse_timestamp(F.col("InvoiceDate")))
    got = by_customer(features.scoring_features(rows, dt.datetime(2024, 1, 1)))
    assert got[12345]["Recency"] == 30 and got[67890]["CustomerLifetime"] == 35
