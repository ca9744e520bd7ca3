"""Cleaning of raw transactions, its audit, the outlier fences and the quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybasket.functions import columns as fx
from tallybasket.operators.quantiles import quantile_row

# Fence width, and the upper limit a single amount may have.
FENCE_WIDTH = 1.5
MAX_AMOUNT = 1_000_000


def with_nulls(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[fx.nan_to_null(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def drop_missing_customers(raw: DataFrame) -> DataFrame:
    """The filter stands on the raw column, so that its null test reaches the scan."""
    known = F.col("CustomerID").isNotNull()
    if isinstance(raw.schema["CustomerID"].dataType, (T.DoubleType, T.FloatType)):
        known = known & ~F.isnan("CustomerID")
    return with_nulls(raw.where(known))


def integer_customer_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("CustomerID", F.col("CustomerID").cast("long"))


def keep_purchases(df: DataFrame) -> DataFrame:
    """Rows with a positive quantity; cancellations are negative, and zero goes too."""
    return df.where(F.col("Quantity") > 0)


def with_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("Amount", F.col("Quantity") * F.col("UnitPrice"))


def with_date_parts(df: DataFrame) -> DataFrame:
    ts = F.col("InvoiceDate")
    return df.withColumns({"YearMonth": fx.year_month(ts), "DayOfWeek": fx.day_name(ts), "Hour": F.hour(ts)})


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Known customers and positive quantities only, with amount and date parts. Map-only."""
    return with_date_parts(with_amount(keep_purchases(integer_customer_ids(drop_missing_customers(raw)))))


def _audit_counts() -> list[Column]:
    known = F.col("CustomerID").isNotNull()
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~known).alias("removed_missing_customer"),
        F.count_if(known & (F.col("Quantity") < 0)).alias("removed_cancellations"),
        F.count_if(known & ((F.col("Quantity") == 0) | F.col("Quantity").isNull())).alias("removed_no_quantity"),
        F.count_if(known & (F.col("Quantity") > 0)).alias("rows_out"),
    ]


def _audited(counts: DataFrame) -> DataFrame:
    return counts.select(
        "*",
        (F.col("rows_in") - F.col("rows_out")).alias("removed_total"),
        fx.percent(F.col("rows_out"), F.col("rows_in")).alias("retention_pct"),
    )


def cleaning_audit(raw: DataFrame) -> DataFrame:
    """How many rows each cleaning step removes, in one pass over the raw rows."""
    return _audited(with_nulls(raw).agg(*_audit_counts()))


def observed_cleaning(raw: DataFrame) -> tuple[DataFrame, Observation, Observation]:
    """Clean rows, and the counts of the audit and of the checks that whatever action reads these rows makes on its way.

    The counts cost no scan of their own; they are there once the rows have been written.
    """
    audit, checks = Observation("audit"), Observation("checks")
    clean = clean_transactions(with_nulls(raw).observe(audit, *_audit_counts()))
    return clean.observe(checks, *_check_counts()), audit, checks


def observed_audit(spark: SparkSession, audit: Observation) -> DataFrame:
    """The row of ``cleaning_audit`` from what was observed."""
    return _audited(_one_row(spark, audit))


def observed_checks(spark: SparkSession, checks: Observation) -> DataFrame:
    """The rows of ``quality_checks`` from what was observed."""
    return _judged(_one_row(spark, checks))


def _one_row(spark: SparkSession, seen: Observation) -> DataFrame:
    values = seen.get
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{c} long" for c in values))


def amount_summary(clean: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of Amount, as one row."""
    quartiles = quantile_row(clean, ["Amount"], [0.25, 0.5, 0.75]).select("Amount").scalar()
    amount = F.col("Amount")
    moments = clean.agg(
        F.count(amount).alias("count"),
        F.avg(amount).alias("mean"),
        F.stddev_samp(amount).alias("std"),
        F.min(amount).alias("min"),
        F.max(amount).alias("max"),
    )
    return moments.select(
        "count",
        "mean",
        "std",
        "min",
        *[quartiles.getItem(i).alias(q) for i, q in enumerate(("q25", "q50", "q75"))],
        "max",
    )


def outlier_fences(clean: DataFrame) -> DataFrame:
    """One row: first and third quartile of Amount and the fences around them."""
    quartiles = quantile_row(clean, ["Amount"], [0.25, 0.75])
    q1, q3 = F.col("Amount")[0], F.col("Amount")[1]
    return quartiles.select(
        q1.alias("q1"),
        q3.alias("q3"),
        (q3 - q1).alias("iqr"),
        (q1 - FENCE_WIDTH * (q3 - q1)).alias("lower_bound"),
        (q3 + FENCE_WIDTH * (q3 - q1)).alias("upper_bound"),
    )


def flag_outliers(clean: DataFrame) -> DataFrame:
    """Mark rows outside the fences. Outliers are reported, never removed."""
    fences = outlier_fences(clean).select(F.struct("lower_bound", "upper_bound")).scalar()
    outside = (F.col("Amount") < fences.getField("lower_bound")) | (F.col("Amount") > fences.getField("upper_bound"))
    return clean.withColumn("IsOutlier", F.coalesce(outside, F.lit(False)))


def outlier_report(clean: DataFrame) -> DataFrame:
    """The fences and the number of rows outside them."""
    fences = outlier_fences(clean).select(F.struct("*")).scalar()
    bounds = ["q1", "q3", "iqr", "lower_bound", "upper_bound"]
    amount = F.col("Amount")
    outside = (amount < fences.getField("lower_bound")) | (amount > fences.getField("upper_bound"))
    counts = clean.agg(F.count_if(outside).alias("n_outliers"), F.count(F.lit(1)).alias("n_rows"))
    return counts.select(*[fences.getField(b).alias(b) for b in bounds], "n_outliers", "n_rows")


# Check names and message endings.
CHECK_ENDINGS = {
    "missing_customers": "missing CustomerIDs",
    "negative_quantities": "non-positive quantities",
    "invalid_dates": "invalid dates",
    "invalid_amounts": "invalid amounts",
}


def _check_counts() -> list[Column]:
    checks = {
        "missing_customers": F.col("CustomerID").isNull(),
        "negative_quantities": F.col("Quantity") <= 0,
        "invalid_dates": F.col("InvoiceDate").isNull(),
        "invalid_amounts": F.col("Amount") <= 0,
    }
    return [F.count_if(bad).alias(name) for name, bad in checks.items()]


def _judged(counts: DataFrame) -> DataFrame:
    endings = F.create_map(*[F.lit(x) for item in CHECK_ENDINGS.items() for x in item])
    return counts.unpivot([], list(CHECK_ENDINGS), "check", "n").select(
        "check",
        F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"),
        "n",
        F.concat_ws(" ", F.col("n").cast("string"), endings[F.col("check")]).alias("message"),
    )


def quality_checks(df: DataFrame) -> DataFrame:
    """Four checks, each with status, count and message. Failing rows are counted, not removed."""
    return _judged(with_nulls(df).agg(*_check_counts()))


def _reasons(date_text: Column) -> Column:
    amount, quantity = F.col("Amount"), F.col("Quantity")
    reasons = {
        "missing_customer": F.col("CustomerID").isNull(),
        "amount_not_positive": amount.isNull() | (amount <= 0),
        "amount_too_high": amount > MAX_AMOUNT,
        "quantity_not_positive": quantity.isNull() | (quantity <= 0),
        "date_not_parsable": fx.parse_timestamp(date_text, strict=False).isNull(),
    }
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in reasons.items()]))


def check_scoring_rows(rows: DataFrame) -> DataFrame:
    """Add the array of reasons for which a row is refused; an empty array is a valid row."""
    return with_nulls(rows).withColumn("reasons", _reasons(F.col("InvoiceDate").cast("string")))


def split_scoring_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows with a parsed date, and refused rows with their reasons."""
    checked = check_scoring_rows(rows)
    ok = F.size("reasons") == 0
    valid = checked.where(ok).drop("reasons")
    parsed = fx.parse_timestamp(F.col("InvoiceDate").cast("string"), strict=False)
    return valid.withColumn("InvoiceDate", parsed), checked.where(~ok)
