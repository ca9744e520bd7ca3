"""Explicit schemas for the tables that enter or leave the library."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

CLEAN_TRANSACTIONS = T.StructType(
    [f if f.name != "CustomerID" else T.StructField("CustomerID", T.LongType()) for f in RAW_TRANSACTIONS.fields]
    + [
        T.StructField("Amount", T.DoubleType()),
        T.StructField("YearMonth", T.StringType()),
        T.StructField("DayOfWeek", T.StringType()),
        T.StructField("Hour", T.IntegerType()),
    ]
)

# A batch file for scoring: the date arrives as text and is parsed by the job.
SCORING_INPUT_TEXT = T.StructType(
    [
        T.StructField("CustomerID", T.LongType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("Amount", T.DoubleType()),
        T.StructField("Quantity", T.IntegerType()),
    ]
)

# Column lists that define the model's inputs and the profile.
CLUSTERING_FEATURES = [
    "Recency",
    "Frequency",
    "Monetary",
    "AvgTransactionValue",
    "CustomerLifetime",
    "PurchaseFrequency",
]
SKEWED_FEATURES = ["Frequency", "Monetary", "AvgTransactionValue", "TotalTransactions"]
PROFILE_METRICS = [
    "Recency",
    "Frequency",
    "Monetary",
    "AvgTransactionValue",
    "CustomerLifetime",
    "PurchaseFrequency",
    "TotalTransactions",
]
SCORING_COLUMNS = ["CustomerID", "InvoiceDate", "Amount", "Quantity"]


def require_columns(df, needed: list[str]) -> None:
    """Fail before any job runs, naming every absent column."""
    absent = [c for c in needed if c not in df.columns]
    if absent:
        raise ValueError(f"Missing required columns: {absent}")
