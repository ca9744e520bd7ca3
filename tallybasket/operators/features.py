"""One row of recency, frequency, monetary and behavioural features per customer.

Training and scoring define some features differently, so both forms are kept apart:

=================  ======================  ====================
feature            training                scoring
=================  ======================  ====================
recency counts to  last date + 1 day       the given ``as_of``
Frequency          distinct invoices       rows
unique days        distinct timestamps     distinct dates
=================  ======================  ====================
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybasket.functions import columns as fx
from tallybasket.schemas import SCORING_COLUMNS, require_columns


def reference_date(clean: DataFrame, given: dt.datetime | None = None) -> Column:
    """The given date, or one day after the last transaction, time of day kept."""
    if given is not None:
        return F.lit(given)
    last = clean.agg(F.max("InvoiceDate").alias("last")).scalar()
    return last + F.expr("INTERVAL 1 DAY")


def _rfm_aggregates() -> list[Column]:
    return [
        F.max("InvoiceDate").alias("_last"),
        F.countDistinct("InvoiceNo").alias("Frequency"),
        fx.sum_or_zero(F.col("Amount")).alias("Monetary"),
    ]


def _behaviour_aggregates() -> list[Column]:
    amount, ts = F.col("Amount"), F.col("InvoiceDate")
    return [
        F.avg(amount).alias("AvgTransactionValue"),
        F.stddev_samp(amount).alias("StdTransactionValue"),
        F.count(amount).alias("TotalTransactions"),
        fx.sum_or_zero(F.col("Quantity")).alias("TotalQuantity"),
        F.min(ts).alias("FirstPurchaseDate"),
        F.max(ts).alias("LastPurchaseDate"),
        F.countDistinct(ts).alias("UniquePurchaseDays"),
        F.countDistinct("StockCode").alias("UniqueProducts"),
    ]


def _derived() -> dict[str, Column]:
    rows = F.col("TotalTransactions")
    return {
        "CustomerLifetime": fx.whole_days(F.col("LastPurchaseDate"), F.col("FirstPurchaseDate")) + 1,
        "PurchaseFrequency": fx.ratio(rows, F.col("UniquePurchaseDays")),
        "AvgBasketSize": fx.ratio(F.col("TotalQuantity"), rows),
        "ProductVariety": fx.ratio(F.col("UniqueProducts"), rows),
    }


RFM_COLUMNS = ["CustomerID", "Recency", "Frequency", "Monetary"]


def rfm_features(clean: DataFrame, given_date: dt.datetime | None = None) -> DataFrame:
    grouped = clean.groupBy("CustomerID").agg(*_rfm_aggregates())
    until = reference_date(clean, given_date)
    return grouped.withColumn("Recency", fx.whole_days(until, F.col("_last"))).select(*RFM_COLUMNS)


def behavioural_features(clean: DataFrame) -> DataFrame:
    return clean.groupBy("CustomerID").agg(*_behaviour_aggregates()).withColumns(_derived())


def join_features(rfm: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Inner join of the two feature tables on CustomerID."""
    return rfm.join(behaviour, "CustomerID", "inner")


def customer_features(clean: DataFrame, given_date: dt.datetime | None = None) -> DataFrame:
    """All features from a single grouping: one pass over the rows and no join.

    The distinct counts are grouped by (customer, value) before they are grouped by
    customer, so a customer with a third of all rows is spread over many tasks.
    """
    last, *rfm = _rfm_aggregates()
    grouped = clean.groupBy("CustomerID").agg(*rfm, *_behaviour_aggregates()).withColumns(_derived())
    until = reference_date(clean, given_date)
    grouped = grouped.withColumn("Recency", fx.whole_days(until, F.col("LastPurchaseDate")))
    rest = [c for c in grouped.columns if c not in RFM_COLUMNS]
    return grouped.select(*RFM_COLUMNS, *rest)


def scoring_features(rows: DataFrame, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Features of customers to be scored, from (CustomerID, InvoiceDate, Amount, Quantity)."""
    require_columns(rows, SCORING_COLUMNS)
    if as_of is None:
        as_of = F.current_timestamp()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    amount, ts = F.col("Amount"), F.col("InvoiceDate")
    grouped = (
        rows.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(
            F.count(F.lit(1)).alias("Frequency"),
            fx.sum_or_zero(amount).alias("Monetary"),
            F.avg(amount).alias("AvgTransactionValue"),
            F.stddev_samp(amount).alias("StdTransactionValue"),
            F.count(F.lit(1)).alias("TotalTransactions"),
            fx.sum_or_zero(F.col("Quantity")).alias("TotalQuantity"),
            F.min(ts).alias("_first"),
            F.max(ts).alias("_last"),
            F.countDistinct(F.to_date(ts)).alias("_days"),
        )
    )
    return grouped.select(
        "CustomerID",
        fx.whole_days(as_of, F.col("_last")).alias("Recency"),
        "Frequency",
        "Monetary",
        "AvgTransactionValue",
        "StdTransactionValue",
        "TotalTransactions",
        "TotalQuantity",
        (fx.whole_days(F.col("_last"), F.col("_first")) + 1).alias("CustomerLifetime"),
        F.when(F.col("_days") > 0, F.col("TotalTransactions") / F.col("_days"))
        .otherwise(F.lit(0.0))
        .alias("PurchaseFrequency"),
    )
