"""The given tables seen as purchase transactions, in Spark and as SQL with the same meaning.

``tx`` is built from order lines; ``ev`` from the event table, whose timestamps carry a
time of day. The given tables hold no missing or negative values, so the mapping makes them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybasket.operators.cleaning import clean_transactions
from tallybasket.operators.features import customer_features
from tallybasket.session import materialize

AS_OF = dt.datetime(2024, 2, 1)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tx(spark: SparkSession, sf_dir: str, described: bool = False) -> DataFrame:
    """Raw transactions; ``described`` adds Description and Country, which few queries need."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    lines = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if described:
        joined = (
            joined.join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        )
    extra = [F.col("p_name").alias("Description"), F.col("n_name").alias("Country")] if described else []
    free = (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)
    return joined.select(
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .cast("int")
        .alias("Quantity"),
        F.col("o_orderdate").cast("timestamp").alias("InvoiceDate"),
        F.when(free, F.lit(0.0)).otherwise(F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").cast("double")).alias("CustomerID"),
        *extra,
    )


TX_SQL = """tx AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "InvoiceNo", CAST(l_partkey AS VARCHAR) AS "StockCode",
         p_name AS "Description",
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS "Quantity",
         o_orderdate AS "InvoiceDate",
         CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN 0.0 ELSE l_extendedprice / l_quantity END AS "UnitPrice",
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS DOUBLE) END AS "CustomerID",
         n_name AS "Country"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""

CLEAN_SQL = (
    TX_SQL
    + """, clean AS (
  SELECT "InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice",
         CAST("CustomerID" AS BIGINT) AS "CustomerID", "Quantity" * "UnitPrice" AS "Amount",
         strftime("InvoiceDate", '%Y-%m') AS "YearMonth", dayname("InvoiceDate") AS "DayOfWeek",
         CAST(hour("InvoiceDate") AS BIGINT) AS "Hour"
  FROM tx WHERE "CustomerID" IS NOT NULL AND "Quantity" > 0)"""
)


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as clean transactions with a time of day."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("InvoiceNo"),
        F.col("event_type").alias("StockCode"),
        (1 + F.col("event_id") % 5).cast("int").alias("Quantity"),
        F.col("ts").cast("timestamp").alias("InvoiceDate"),
        F.col("user_id").alias("CustomerID"),
        F.col("value").alias("Amount"),
    )


EV_SQL = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS "InvoiceNo", event_type AS "StockCode",
         CAST(1 + event_id % 5 AS INTEGER) AS "Quantity", ts AS "InvoiceDate", user_id AS "CustomerID",
         value AS "Amount" FROM events)"""


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(tx(spark, sf_dir))


def days_sql(later: str, earlier: str) -> str:
    """Whole 24-hour periods between two timestamps, rounded down."""
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


def features_sql(source: str, ctes: str) -> str:
    """All customer features of the training side, as CTE ``feat`` over ``source``."""
    return (
        ctes
        + f""", grouped AS (
  SELECT "CustomerID", max("InvoiceDate") AS "LastPurchaseDate", min("InvoiceDate") AS "FirstPurchaseDate",
         count(DISTINCT "InvoiceNo") AS "Frequency", coalesce(sum("Amount"), 0) AS "Monetary",
         avg("Amount") AS "AvgTransactionValue", stddev_samp("Amount") AS "StdTransactionValue",
         count("Amount") AS "TotalTransactions", CAST(coalesce(sum("Quantity"), 0) AS BIGINT) AS "TotalQuantity",
         count(DISTINCT "InvoiceDate") AS "UniquePurchaseDays", count(DISTINCT "StockCode") AS "UniqueProducts"
  FROM {source} GROUP BY "CustomerID"),
feat AS (
  SELECT "CustomerID", {days_sql(f'(SELECT max("InvoiceDate") + INTERVAL 1 DAY FROM {source})', '"LastPurchaseDate"')} AS "Recency",
         "Frequency", "Monetary", "AvgTransactionValue", "StdTransactionValue", "TotalTransactions", "TotalQuantity",
         "FirstPurchaseDate", "LastPurchaseDate", "UniquePurchaseDays", "UniqueProducts",
         {days_sql('"LastPurchaseDate"', '"FirstPurchaseDate"')} + 1 AS "CustomerLifetime",
         CAST("TotalTransactions" AS DOUBLE) / "UniquePurchaseDays" AS "PurchaseFrequency",
         CAST("TotalQuantity" AS DOUBLE) / "TotalTransactions" AS "AvgBasketSize",
         CAST("UniqueProducts" AS DOUBLE) / "TotalTransactions" AS "ProductVariety"
  FROM grouped)"""
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features, written once because the queries on them make several passes."""
    return materialize(customer_features(clean(spark, sf_dir)), "features")


FEATURES_SQL = features_sql("clean", CLEAN_SQL)


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features with a given grouping: five market segments as clusters 0 to 4.

    Cluster 4 has no name among the four named segments.
    """
    market = F.array(*[F.lit(m) for m in MARKETS])
    groups = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerID"),
        (F.array_position(market, F.col("c_mktsegment")) - 1).cast("int").alias("Cluster"),
    )
    return materialize(customer_features(clean(spark, sf_dir)).join(groups, "CustomerID"), "clustered")


MARKETS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

CLUSTERED_SQL = (
    FEATURES_SQL
    + f""", clustered AS (
  SELECT feat.*, CAST(list_position({MARKETS!r}, c_mktsegment) - 1 AS INTEGER) AS "Cluster"
  FROM feat JOIN customer ON c_custkey = "CustomerID")"""
)


def r(expr: str, digits: int = 4) -> str:
    """Rounding for comparison; adding zero removes the sign of a negative zero.

    Averages of cents often end exactly halfway between two rounded values, where the last
    bit of a sum would decide. A shift far below the rounding step moves them off the half.
    """
    return f"(round(CAST({expr} AS DOUBLE) + {shift(digits)!r}, {digits}) + 0e0)"


def shift(digits: int) -> float:
    return 3.17 * 10.0 ** (-digits - 4)


def text_ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def comparable(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round doubles, widen integers and print timestamps, so that two engines' rows compare."""
    out = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            col = F.round(col.cast("double") + F.lit(shift(digits)), digits) + F.lit(0.0)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.DoubleType):
            col = F.transform(col, lambda x: F.round(x + F.lit(shift(digits)), digits) + F.lit(0.0))
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            col = col.cast("long")
        elif isinstance(kind, T.TimestampType):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        out.append(col.alias(field.name))
    return df.select(*out)
