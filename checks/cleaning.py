"""Sources, cleaning, quality and outlier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import tables as t
from checks.tables import r
from tallybasket.functions import columns as fx
from tallybasket.operators import cleaning as ops
from tallybasket.sources import transactions as src

CLEAN_ROWS = ["CustomerID", "InvoiceNo", "StockCode", "Quantity"]


def load_profile(spark, sf_dir):
    return t.comparable(src.load_profile(t.tx(spark, sf_dir, described=True)))


def raw_scan(spark, sf_dir):
    raw = src.read_parquet_table(spark, src.write_parquet_table(t.tx(spark, sf_dir, described=True)))
    grouped = raw.groupBy("Country").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("Description").alias("n_descriptions"),
        F.sum("Quantity").alias("quantity"),
        F.avg("UnitPrice").alias("avg_unit_price"),
    )
    return t.comparable(grouped)


def processed_csv_round_trip(spark, sf_dir):
    """Write the clean rows as CSV, read them back with their schema, compare by month."""
    path = src.write_clean_csv(t.clean(spark, sf_dir))
    back = src.read_processed_csv(spark, path)
    grouped = back.groupBy("YearMonth", "DayOfWeek").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("Amount").alias("amount"),
        F.countDistinct("CustomerID").alias("customers"),
        F.max("InvoiceDate").alias("last"),
    )
    return t.comparable(grouped, 2)


def drop_missing_customers(spark, sf_dir):
    kept = ops.drop_missing_customers(t.tx(spark, sf_dir))
    return t.comparable(kept.select(*CLEAN_ROWS))


def integer_customer_ids(spark, sf_dir):
    kept = ops.integer_customer_ids(ops.drop_missing_customers(t.tx(spark, sf_dir)))
    return t.comparable(kept.select(*CLEAN_ROWS))


def keep_purchases(spark, sf_dir):
    return t.comparable(ops.keep_purchases(t.tx(spark, sf_dir)).select("InvoiceNo", "StockCode", "Quantity"))


def amounts(spark, sf_dir):
    return t.comparable(t.clean(spark, sf_dir).select(*CLEAN_ROWS, "Amount"), 2)


def date_parts(cols):
    def run(spark, sf_dir):
        return t.comparable(t.clean(spark, sf_dir).select("InvoiceNo", "StockCode", *cols))

    return run


def hours_of_events(spark, sf_dir):
    parts = ops.with_date_parts(t.ev(spark, sf_dir))
    return t.comparable(parts.select("InvoiceNo", "YearMonth", "DayOfWeek", "Hour"))


def flagged(spark, sf_dir):
    rows = ops.flag_outliers(t.clean(spark, sf_dir))
    return t.comparable(rows.select(*CLEAN_ROWS, "Amount", "IsOutlier"), 2)


def quality_clean(spark, sf_dir):
    return t.comparable(ops.quality_checks(t.clean(spark, sf_dir)))


def quality_raw(spark, sf_dir):
    return t.comparable(ops.quality_checks(ops.with_amount(t.tx(spark, sf_dir))))


def validated(spark, sf_dir):
    """Order lines as scoring rows with date text, some of it broken."""
    rows = ops.with_amount(t.tx(spark, sf_dir)).withColumn("Amount", F.col("Amount") * 30)
    text = F.date_format("InvoiceDate", "yyyy-MM-dd'T'HH:mm:ss")
    rows = rows.withColumn(
        "InvoiceDate", F.when(F.col("Quantity") == 7, F.concat(F.lit("day "), text)).otherwise(text)
    )
    checked = ops.check_scoring_rows(rows)
    return checked.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


def parsed_dates(spark, sf_dir):
    """Date text in two forms, parsed strictly; every tenth event has date only."""
    events = t.ev(spark, sf_dir)
    text = F.when(F.col("Quantity") == 3, F.date_format("InvoiceDate", "yyyy-MM-dd")).otherwise(
        F.date_format("InvoiceDate", "yyyy-MM-dd'T'HH:mm:ss")
    )
    return t.comparable(events.select("InvoiceNo", fx.parse_timestamp(text).alias("parsed")))


QUERIES = {
    "a1_raw_scan": raw_scan,
    "a2_load_profile": load_profile,
    "a3_processed_csv_round_trip": processed_csv_round_trip,
    "b1_drop_missing_customers": drop_missing_customers,
    "b2_integer_customer_ids": integer_customer_ids,
    "b3_keep_purchases": keep_purchases,
    "b4_amount": amounts,
    "b5_year_month": date_parts(["YearMonth"]),
    "b6_day_of_week": date_parts(["DayOfWeek"]),
    "b7_hour": date_parts(["Hour"]),
    "b8_outliers": flagged,
    "b17_parse_dates": parsed_dates,
    "b18_row_validation": validated,
    "d10_amount_summary": lambda s, d: t.comparable(ops.amount_summary(t.clean(s, d))),
    "d11_outlier_report": lambda s, d: t.comparable(ops.outlier_report(t.clean(s, d))),
    "d12_quality_checks": quality_clean,
    "d12_quality_checks_raw": quality_raw,
    "d13_cleaning_audit": lambda s, d: t.comparable(ops.cleaning_audit(t.tx(s, d))),
    "h4_date_parts_of_events": hours_of_events,
}

_QUALITY = """SELECT 'missing_customers' AS "check", count(*) FILTER ("CustomerID" IS NULL) AS n, 'missing CustomerIDs' AS ending FROM {src}
  UNION ALL SELECT 'negative_quantities', count(*) FILTER ("Quantity" <= 0), 'non-positive quantities' FROM {src}
  UNION ALL SELECT 'invalid_dates', count(*) FILTER ("InvoiceDate" IS NULL), 'invalid dates' FROM {src}
  UNION ALL SELECT 'invalid_amounts', count(*) FILTER ("Quantity" * "UnitPrice" <= 0), 'invalid amounts' FROM {src}"""


def _quality(source):
    return f"""WITH {t.CLEAN_SQL}, c AS ({_QUALITY.format(src=source)})
SELECT "check", CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n,
       CAST(n AS VARCHAR) || ' ' || ending AS message FROM c"""


_FENCES = """fences AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
  FROM (SELECT quantile_cont("Amount", 0.25) AS q1, quantile_cont("Amount", 0.75) AS q3 FROM clean))"""

ORACLES = {
    "a1_raw_scan": f"""WITH {t.TX_SQL} SELECT "Country", count(*) AS n, count(DISTINCT "Description") AS n_descriptions,
  CAST(sum("Quantity") AS BIGINT) AS quantity, {r('avg("UnitPrice")')} AS avg_unit_price FROM tx GROUP BY "Country" """,
    "a2_load_profile": f"""WITH {t.TX_SQL} SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS n_columns,
  {t.text_ts('min("InvoiceDate")')} AS first_date, {t.text_ts('max("InvoiceDate")')} AS last_date,
  count(DISTINCT "CustomerID") AS n_customers, count(DISTINCT "StockCode") AS n_products FROM tx""",
    "a3_processed_csv_round_trip": f"""WITH {t.CLEAN_SQL} SELECT "YearMonth", "DayOfWeek", count(*) AS n,
  {r('sum("Amount")', 2)} AS amount, count(DISTINCT "CustomerID") AS customers, {t.text_ts('max("InvoiceDate")')} AS "last"
  FROM clean GROUP BY "YearMonth", "DayOfWeek" """,
    "b1_drop_missing_customers": f"""WITH {t.TX_SQL} SELECT "CustomerID", "InvoiceNo", "StockCode",
  CAST("Quantity" AS BIGINT) AS "Quantity" FROM tx WHERE "CustomerID" IS NOT NULL""",
    "b2_integer_customer_ids": f"""WITH {t.TX_SQL} SELECT CAST("CustomerID" AS BIGINT) AS "CustomerID", "InvoiceNo", "StockCode",
  CAST("Quantity" AS BIGINT) AS "Quantity" FROM tx WHERE "CustomerID" IS NOT NULL""",
    "b3_keep_purchases": f"""WITH {t.TX_SQL} SELECT "InvoiceNo", "StockCode", CAST("Quantity" AS BIGINT) AS "Quantity"
  FROM tx WHERE "Quantity" > 0""",
    "b4_amount": f"""WITH {t.CLEAN_SQL} SELECT "CustomerID", "InvoiceNo", "StockCode", CAST("Quantity" AS BIGINT) AS "Quantity",
  {r('"Amount"', 2)} AS "Amount" FROM clean""",
    "b5_year_month": f'WITH {t.CLEAN_SQL} SELECT "InvoiceNo", "StockCode", "YearMonth" FROM clean',
    "b6_day_of_week": f'WITH {t.CLEAN_SQL} SELECT "InvoiceNo", "StockCode", "DayOfWeek" FROM clean',
    "b7_hour": f'WITH {t.CLEAN_SQL} SELECT "InvoiceNo", "StockCode", "Hour" FROM clean',
    "b8_outliers": f"""WITH {t.CLEAN_SQL}, {_FENCES} SELECT "CustomerID", "InvoiceNo", "StockCode",
  CAST("Quantity" AS BIGINT) AS "Quantity", {r('"Amount"', 2)} AS "Amount",
  "Amount" < (SELECT lower_bound FROM fences) OR "Amount" > (SELECT upper_bound FROM fences) AS "IsOutlier" FROM clean""",
    "b17_parse_dates": f"""WITH {t.EV_SQL} SELECT "InvoiceNo",
  {t.text_ts('''CASE WHEN "Quantity" = 3 THEN date_trunc('day', "InvoiceDate") ELSE date_trunc('second', "InvoiceDate") END''')}
  AS parsed FROM ev""",
    "b18_row_validation": f"""WITH {t.TX_SQL}, x AS (SELECT *, "Quantity" * "UnitPrice" * 30 AS "Amount" FROM tx),
reasons AS (SELECT concat_ws(',', CASE WHEN "CustomerID" IS NULL THEN 'missing_customer' END,
    CASE WHEN "Amount" <= 0 THEN 'amount_not_positive' END, CASE WHEN "Amount" > 1000000 THEN 'amount_too_high' END,
    CASE WHEN "Quantity" <= 0 THEN 'quantity_not_positive' END, CASE WHEN "Quantity" = 7 THEN 'date_not_parsable' END)
    AS reasons FROM x)
SELECT reasons, count(*) AS n FROM reasons GROUP BY reasons""",
    "d10_amount_summary": f"""WITH {t.CLEAN_SQL} SELECT count("Amount") AS "count", {r('avg("Amount")')} AS "mean",
  {r('stddev_samp("Amount")')} AS std, {r('min("Amount")')} AS "min", {r('quantile_cont("Amount", 0.25)')} AS q25,
  {r('quantile_cont("Amount", 0.5)')} AS q50, {r('quantile_cont("Amount", 0.75)')} AS q75, {r('max("Amount")')} AS "max"
  FROM clean""",
    "d11_outlier_report": f"""WITH {t.CLEAN_SQL}, {_FENCES} SELECT {r('any_value(q1)')} AS q1, {r('any_value(q3)')} AS q3,
  {r('any_value(iqr)')} AS iqr, {r('any_value(lower_bound)')} AS lower_bound, {r('any_value(upper_bound)')} AS upper_bound,
  count(*) FILTER ("Amount" < lower_bound OR "Amount" > upper_bound) AS n_outliers, count(*) AS n_rows FROM clean, fences""",
    "d12_quality_checks": _quality("clean"),
    "d12_quality_checks_raw": _quality("tx"),
    "d13_cleaning_audit": f"""WITH {t.TX_SQL}, c AS (SELECT count(*) AS rows_in,
  count(*) FILTER ("CustomerID" IS NULL) AS removed_missing_customer,
  count(*) FILTER ("CustomerID" IS NOT NULL AND "Quantity" < 0) AS removed_cancellations,
  count(*) FILTER ("CustomerID" IS NOT NULL AND coalesce("Quantity", 0) = 0) AS removed_no_quantity,
  count(*) FILTER ("CustomerID" IS NOT NULL AND "Quantity" > 0) AS rows_out FROM tx)
SELECT *, rows_in - rows_out AS removed_total, {r('rows_out * 100.0 / rows_in')} AS retention_pct FROM c""",
    "h4_date_parts_of_events": f"""WITH {t.EV_SQL} SELECT "InvoiceNo", strftime("InvoiceDate", '%Y-%m') AS "YearMonth",
  dayname("InvoiceDate") AS "DayOfWeek", CAST(hour("InvoiceDate") AS BIGINT) AS "Hour" FROM ev""",
}
