"""Customer features, preparation for clustering, scaling and RFM scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import tables as t
from checks.tables import r
from tallybasket.operators import features as ops
from tallybasket.operators import preparation as prep
from tallybasket.operators import rfm_scores
from tallybasket.schemas import CLUSTERING_FEATURES
from tallybasket.session import materialize

FINAL = prep.final_feature_names(CLUSTERING_FEATURES)


def reference_date(spark, sf_dir):
    """The reference date beside the days that separate it from each month's last purchase."""
    clean = t.clean(spark, sf_dir)
    until = ops.reference_date(clean)
    grouped = clean.groupBy("YearMonth").agg(F.max("InvoiceDate").alias("last"))
    return t.comparable(grouped.select("YearMonth", "last", until.alias("reference_date")))


def recency(spark, sf_dir):
    return t.comparable(ops.rfm_features(t.ev(spark, sf_dir)).select("CustomerID", "Recency"))


def recency_from_given_date(spark, sf_dir):
    return t.comparable(ops.rfm_features(t.ev(spark, sf_dir), t.AS_OF).select("CustomerID", "Recency"))


def all_features(spark, sf_dir):
    return t.comparable(ops.customer_features(t.clean(spark, sf_dir)))


def joined_features(spark, sf_dir):
    clean = t.clean(spark, sf_dir)
    return t.comparable(ops.join_features(ops.rfm_features(clean), ops.behavioural_features(clean)))


def behaviour(*cols):
    def run(spark, sf_dir):
        return t.comparable(ops.behavioural_features(t.clean(spark, sf_dir)).select("CustomerID", *cols))

    return run


def event_lifetimes(spark, sf_dir):
    got = ops.behavioural_features(t.ev(spark, sf_dir))
    return t.comparable(got.select("CustomerID", "CustomerLifetime", "UniquePurchaseDays", "PurchaseFrequency"))


def scoring_features(spark, sf_dir):
    return t.comparable(ops.scoring_features(t.ev(spark, sf_dir), t.AS_OF))


def scoring_recency(spark, sf_dir):
    return t.comparable(ops.scoring_features(t.ev(spark, sf_dir), t.AS_OF).select("CustomerID", "Recency"))


def selected(spark, sf_dir):
    return t.comparable(prep.select_clustering_features(ops.customer_features(t.clean(spark, sf_dir))))


def spenders(spark, sf_dir):
    """Customers with and without spend."""
    return t.comparable(prep.spend_audit(ops.customer_features(t.clean(spark, sf_dir))))


def with_gaps(spark, sf_dir):
    """Features whose deviation is missing for one-row customers, the column to be filled."""
    cols = ["Recency", "StdTransactionValue", "PurchaseFrequency"]
    # Customers with few rows count as missing their purchase frequency.
    few = F.col("TotalTransactions") < 12
    picked = t.features(spark, sf_dir).select(
        "CustomerID",
        "Recency",
        "StdTransactionValue",
        F.when(~few, F.col("PurchaseFrequency")).alias("PurchaseFrequency"),
    )
    return materialize(picked, "gaps"), cols


def filled(spark, sf_dir):
    picked, cols = with_gaps(spark, sf_dir)
    return t.comparable(prep.fill_with_medians(picked, cols))


def missing(spark, sf_dir):
    picked, cols = with_gaps(spark, sf_dir)
    return t.comparable(prep.missing_values(picked, cols))


def logs(spark, sf_dir):
    got = prep.with_logs(ops.customer_features(t.clean(spark, sf_dir)))
    names = [c for c in got.columns if c.startswith("Log_")]
    return t.comparable(got.select("CustomerID", *names), 6)


def matrix(spark, sf_dir):
    return materialize(prep.unscaled_matrix(t.features(spark, sf_dir)), "matrix")


def final_matrix(spark, sf_dir):
    return t.comparable(prep.unscaled_matrix(t.features(spark, sf_dir)), 6)


def scaler(spark, sf_dir):
    return t.comparable(prep.scaler_parameters(matrix(spark, sf_dir), FINAL), 6)


def scaled(spark, sf_dir):
    rows = matrix(spark, sf_dir)
    return t.comparable(prep.scale_features(rows, prep.Scaler.from_table(prep.scaler_parameters(rows, FINAL))))


def scaler_table(spark, sf_dir):
    """The scaler parameters written as a table and read back."""
    rows = matrix(spark, sf_dir)
    return t.comparable(materialize(prep.scaler_parameters(rows, FINAL), "scaler"), 6)


def metadata(spark, sf_dir):
    rows = matrix(spark, sf_dir)
    got = prep.feature_metadata(prep.scaler_parameters(rows, FINAL), rows)
    named = got.withColumn("feature_names", F.array_join("feature_names", ","))
    flat = [F.col(f"{c}")[i].alias(f"{c}_{i}") for c in ("scaler_mean", "scaler_scale") for i in range(len(FINAL))]
    return t.comparable(named.select("feature_names", "n_customers", "n_features", *flat), 6)


def aligned(spark, sf_dir):
    """Scoring features against a model that also wants a feature the rows lack."""
    names = ["Recency", "Log_Frequency", "Log_Monetary", "Log_AvgTransactionValue", "ProductVariety", "CustomerLifetime"]
    got = prep.with_logs(ops.scoring_features(t.ev(spark, sf_dir), t.AS_OF), only=names)
    return t.comparable(prep.align_to_model(got, names))


def scoring_logs(spark, sf_dir):
    got = prep.with_logs(ops.scoring_features(t.ev(spark, sf_dir), t.AS_OF), only=FINAL)
    return t.comparable(got.select("CustomerID", *[c for c in got.columns if c.startswith("Log_")]), 6)


def rfm_segments(spark, sf_dir):
    return t.comparable(rfm_scores.score_rfm(t.features(spark, sf_dir)))


def rfm_segment_sizes(spark, sf_dir):
    return t.comparable(rfm_scores.segment_sizes(rfm_scores.score_rfm(t.features(spark, sf_dir))))


def arithmetic(spark, sf_dir):
    """Product, quotient with a zero divisor, and share of a total, per month."""
    clean = t.clean(spark, sf_dir)
    monthly = clean.groupBy("YearMonth").agg(
        F.sum("Amount").alias("amount"), F.sum(F.when(F.col("UnitPrice") == 0, F.col("Quantity"))).alias("free")
    )
    total = clean.agg(F.sum("Amount")).scalar()
    from tallybasket.functions import columns as fx

    return t.comparable(
        monthly.select(
            "YearMonth",
            fx.ratio(F.col("amount"), F.coalesce("free", F.lit(0))).alias("per_free_item"),
            fx.percent(F.col("amount"), total).alias("share"),
            fx.half_even(fx.percent(F.col("amount"), total), 2).alias("share_2"),
        )
    )


QUERIES = {
    "d1_reference_date": reference_date,
    "d2_recency": recency,
    "d2_recency_from_given_date": recency_from_given_date,
    "d3_rfm": lambda s, d: t.comparable(ops.rfm_features(t.clean(s, d))),
    "d4_behaviour": behaviour(
        "AvgTransactionValue",
        "StdTransactionValue",
        "TotalTransactions",
        "TotalQuantity",
        "FirstPurchaseDate",
        "LastPurchaseDate",
        "UniquePurchaseDays",
        "UniqueProducts",
    ),
    "d5_lifetime": behaviour("CustomerLifetime"),
    "d6_purchase_frequency": behaviour("PurchaseFrequency"),
    "d7_basket_and_variety": behaviour("AvgBasketSize", "ProductVariety"),
    "d5_d6_event_lifetimes": event_lifetimes,
    "d8_scoring_features": scoring_features,
    "d9_scoring_recency": scoring_recency,
    "c1_features_by_join": joined_features,
    "c1_features_one_grouping": all_features,
    "b9_select_features": selected,
    "b10_spend_audit": spenders,
    "b11_fill_medians": filled,
    "d14_missing_values": missing,
    "b12_logs": logs,
    "b13_final_features": final_matrix,
    "b15_align_to_model": aligned,
    "b16_scoring_logs": scoring_logs,
    "i1_scaler_parameters": scaler,
    "i2_scaled_features": scaled,
    "a7_scaler_table": scaler_table,
    "a8_feature_metadata": metadata,
    "e3_rfm_scores": rfm_segments,
    "e3_rfm_segment_sizes": rfm_segment_sizes,
    "h1_arithmetic": arithmetic,
}

_BEHAVIOUR_SQL = {
    "AvgTransactionValue": r('"AvgTransactionValue"'),
    "StdTransactionValue": r('"StdTransactionValue"'),
    "TotalTransactions": '"TotalTransactions"',
    "TotalQuantity": '"TotalQuantity"',
    "FirstPurchaseDate": t.text_ts('"FirstPurchaseDate"'),
    "LastPurchaseDate": t.text_ts('"LastPurchaseDate"'),
    "UniquePurchaseDays": '"UniquePurchaseDays"',
    "UniqueProducts": '"UniqueProducts"',
    "CustomerLifetime": '"CustomerLifetime"',
    "PurchaseFrequency": r('"PurchaseFrequency"'),
    "AvgBasketSize": r('"AvgBasketSize"'),
    "ProductVariety": r('"ProductVariety"'),
}


def _picked(*cols, ctes=t.FEATURES_SQL):
    chosen = ", ".join(f'{_BEHAVIOUR_SQL[c]} AS "{c}"' for c in cols)
    return f'WITH {ctes} SELECT "CustomerID", {chosen} FROM feat'


_RFM = f'"Recency", "Frequency", {r(chr(34) + "Monetary" + chr(34))} AS "Monetary"'
ALL_FEATURES_SQL = f"""WITH {t.FEATURES_SQL} SELECT "CustomerID", {_RFM}, {", ".join(f'{sql} AS "{c}"' for c, sql in _BEHAVIOUR_SQL.items())} FROM feat"""

_EV_FEATURES = t.features_sql("ev", t.EV_SQL)

SCORING_SQL = (
    t.EV_SQL
    + f""", sfeat AS (
  SELECT "CustomerID", {t.days_sql("TIMESTAMP '2024-02-01 00:00:00'", 'max("InvoiceDate")')} AS "Recency",
         count(*) AS "Frequency", sum("Amount") AS "Monetary", avg("Amount") AS "AvgTransactionValue",
         stddev_samp("Amount") AS "StdTransactionValue", count(*) AS "TotalTransactions",
         CAST(sum("Quantity") AS BIGINT) AS "TotalQuantity",
         {t.days_sql('max("InvoiceDate")', 'min("InvoiceDate")')} + 1 AS "CustomerLifetime",
         CAST(count(*) AS DOUBLE) / count(DISTINCT CAST("InvoiceDate" AS DATE)) AS "PurchaseFrequency"
  FROM ev WHERE "CustomerID" IS NOT NULL GROUP BY "CustomerID")"""
)

_GAPS = (
    t.FEATURES_SQL
    + """, gaps AS (SELECT "CustomerID", "Recency", "StdTransactionValue",
  CASE WHEN "TotalTransactions" >= 12 THEN "PurchaseFrequency" END AS "PurchaseFrequency" FROM feat)"""
)

# The unscaled matrix: no feature is missing in the given tables, the median rule is still written out.
_BASE = ["Recency", "Frequency", "Monetary", "AvgTransactionValue", "CustomerLifetime", "PurchaseFrequency"]


def matrix_sql(ctes: str) -> str:
    filled_cols = ", ".join(
        f'coalesce(CAST("{c}" AS DOUBLE), (SELECT median("{c}") FROM feat WHERE "Monetary" > 0)) AS "{c}"' for c in _BASE
    )
    return (
        ctes
        + f""", filled AS (SELECT "CustomerID", {filled_cols} FROM feat WHERE "Monetary" > 0),
matrix AS (SELECT "CustomerID", "Recency", ln(1 + "Frequency") AS "Log_Frequency", ln(1 + "Monetary") AS "Log_Monetary",
  ln(1 + "AvgTransactionValue") AS "Log_AvgTransactionValue", "CustomerLifetime", "PurchaseFrequency" FROM filled)"""
    )


def scaled_sql(ctes: str) -> str:
    parts = ", ".join(
        f'("{c}" - (SELECT avg("{c}") FROM matrix)) / (SELECT CASE WHEN stddev_pop("{c}") = 0 THEN 1 ELSE stddev_pop("{c}") END FROM matrix) AS "{c}"'
        for c in FINAL
    )
    return matrix_sql(ctes) + f', scaled AS (SELECT "CustomerID", {parts} FROM matrix)'


_PARAMETERS = " UNION ALL ".join(
    f"""SELECT CAST({i} AS BIGINT) AS "position", '{c}' AS feature, {r(f'avg("{c}")', 6)} AS "mean",
  {r(f'CASE WHEN stddev_pop("{c}") = 0 THEN 1 ELSE stddev_pop("{c}") END', 6)} AS "scale" FROM matrix"""
    for i, c in enumerate(FINAL)
)
_MATRIX = matrix_sql(t.FEATURES_SQL)

RFM_SCORED_SQL = (
    t.FEATURES_SQL
    + """, tiles AS (SELECT "CustomerID", "Recency", "Frequency", "Monetary",
  ntile(5) OVER (ORDER BY "Recency" DESC, "CustomerID") AS r, ntile(5) OVER (ORDER BY "Frequency", "CustomerID") AS f,
  ntile(5) OVER (ORDER BY "Monetary", "CustomerID") AS m FROM feat),
scored AS (SELECT *, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions' WHEN r >= 3 AND f >= 3 AND m >= 3 THEN 'Loyal Customers'
  WHEN r <= 2 AND m >= 4 THEN 'Can''t Lose Them' WHEN r <= 2 AND f >= 3 THEN 'At Risk' WHEN r >= 3 AND f >= 2 THEN 'Potential Loyalists'
  WHEN r >= 4 THEN 'Promising' ELSE 'Others' END AS "RFM_Segment" FROM tiles)"""
)

ORACLES = {
    "d1_reference_date": f"""WITH {t.CLEAN_SQL} SELECT "YearMonth", {t.text_ts('max("InvoiceDate")')} AS "last",
  {t.text_ts('(SELECT max("InvoiceDate") + INTERVAL 1 DAY FROM clean)')} AS reference_date FROM clean GROUP BY "YearMonth" """,
    "d2_recency": f'WITH {_EV_FEATURES} SELECT "CustomerID", "Recency" FROM feat',
    "d2_recency_from_given_date": f"""WITH {t.EV_SQL} SELECT "CustomerID",
  {t.days_sql("TIMESTAMP '2024-02-01 00:00:00'", 'max("InvoiceDate")')} AS "Recency" FROM ev GROUP BY "CustomerID" """,
    "d3_rfm": f'WITH {t.FEATURES_SQL} SELECT "CustomerID", {_RFM} FROM feat',
    "d4_behaviour": _picked(
        "AvgTransactionValue",
        "StdTransactionValue",
        "TotalTransactions",
        "TotalQuantity",
        "FirstPurchaseDate",
        "LastPurchaseDate",
        "UniquePurchaseDays",
        "UniqueProducts",
    ),
    "d5_lifetime": _picked("CustomerLifetime"),
    "d6_purchase_frequency": _picked("PurchaseFrequency"),
    "d7_basket_and_variety": _picked("AvgBasketSize", "ProductVariety"),
    "d5_d6_event_lifetimes": _picked("CustomerLifetime", "UniquePurchaseDays", "PurchaseFrequency", ctes=_EV_FEATURES),
    "d8_scoring_features": f"""WITH {SCORING_SQL} SELECT "CustomerID", "Recency", "Frequency", {r('"Monetary"')} AS "Monetary",
  {r('"AvgTransactionValue"')} AS "AvgTransactionValue", {r('"StdTransactionValue"')} AS "StdTransactionValue",
  "TotalTransactions", "TotalQuantity", "CustomerLifetime", {r('"PurchaseFrequency"')} AS "PurchaseFrequency" FROM sfeat""",
    "d9_scoring_recency": f'WITH {SCORING_SQL} SELECT "CustomerID", "Recency" FROM sfeat',
    "c1_features_by_join": ALL_FEATURES_SQL,
    "c1_features_one_grouping": ALL_FEATURES_SQL,
    "b9_select_features": f"""WITH {t.FEATURES_SQL} SELECT "CustomerID", {_RFM}, {r('"AvgTransactionValue"')} AS "AvgTransactionValue",
  "CustomerLifetime", {r('"PurchaseFrequency"')} AS "PurchaseFrequency" FROM feat""",
    "b10_spend_audit": f"""WITH {t.CLEAN_SQL}, m AS (SELECT sum("Amount") AS s FROM clean GROUP BY "CustomerID")
SELECT count(*) AS customers, count(*) FILTER (s > 0) AS kept, count(*) FILTER (NOT coalesce(s > 0, false)) AS dropped_zero_spend FROM m""",
    "b11_fill_medians": f"""WITH {_GAPS} SELECT "CustomerID", {", ".join(
        r(f'coalesce(CAST("{c}" AS DOUBLE), (SELECT median("{c}") FROM gaps))') + f' AS "{c}"'
        for c in ("Recency", "StdTransactionValue", "PurchaseFrequency"))} FROM gaps""",
    "d14_missing_values": f"""WITH {_GAPS}, c AS (SELECT count(*) - count("Recency") AS "Recency",
  count(*) - count("StdTransactionValue") AS "StdTransactionValue", count(*) - count("PurchaseFrequency") AS "PurchaseFrequency" FROM gaps)
SELECT *, "Recency" + "StdTransactionValue" + "PurchaseFrequency" AS missing_total FROM c""",
    "b12_logs": f"""WITH {t.FEATURES_SQL} SELECT "CustomerID", {", ".join(
        r(f'ln(1 + "{c}")', 6) + f' AS "Log_{c}"'
        for c in ("Frequency", "Monetary", "AvgTransactionValue", "TotalTransactions"))} FROM feat""",
    "b13_final_features": f"""WITH {_MATRIX} SELECT "CustomerID", {", ".join(r(f'"{c}"', 6) + f' AS "{c}"' for c in FINAL)} FROM matrix""",
    "b15_align_to_model": f"""WITH {SCORING_SQL} SELECT "CustomerID", {r('"Recency"')} AS "Recency", {r('ln(1 + "Frequency")')} AS "Log_Frequency",
  {r('ln(1 + "Monetary")')} AS "Log_Monetary", {r('ln(1 + "AvgTransactionValue")')} AS "Log_AvgTransactionValue",
  CAST(0 AS DOUBLE) AS "ProductVariety", {r('"CustomerLifetime"')} AS "CustomerLifetime" FROM sfeat""",
    "b16_scoring_logs": f"""WITH {SCORING_SQL} SELECT "CustomerID", {", ".join(
        r(f'ln(1 + "{c}")', 6) + f' AS "Log_{c}"' for c in ("Frequency", "Monetary", "AvgTransactionValue"))} FROM sfeat""",
    "i1_scaler_parameters": f"WITH {_MATRIX} {_PARAMETERS}",
    "i2_scaled_features": f"""WITH {scaled_sql(t.FEATURES_SQL)} SELECT "CustomerID", {", ".join(r(f'"{c}"') + f' AS "{c}"' for c in FINAL)} FROM scaled""",
    "a7_scaler_table": f"WITH {_MATRIX} {_PARAMETERS}",
    "a8_feature_metadata": f"""WITH {_MATRIX} SELECT '{",".join(FINAL)}' AS feature_names, count(*) AS n_customers,
  CAST({len(FINAL)} AS BIGINT) AS n_features, {", ".join(r(f'avg("{c}")', 6) + f' AS scaler_mean_{i}' for i, c in enumerate(FINAL))},
  {", ".join(r(f'stddev_pop("{c}")', 6) + f' AS scaler_scale_{i}' for i, c in enumerate(FINAL))} FROM matrix""",
    "e3_rfm_scores": f"""WITH {RFM_SCORED_SQL} SELECT "CustomerID", "Recency", "Frequency", {r('"Monetary"')} AS "Monetary",
  r AS "R_Score", f AS "F_Score", m AS "M_Score", "RFM_Segment" FROM scored""",
    "e3_rfm_segment_sizes": f"""WITH {RFM_SCORED_SQL} SELECT "RFM_Segment", count(*) AS customers FROM scored GROUP BY "RFM_Segment" """,
    "h1_arithmetic": f"""WITH {t.CLEAN_SQL}, m AS (SELECT "YearMonth", sum("Amount") AS amount,
  coalesce(sum(CASE WHEN "UnitPrice" = 0 THEN "Quantity" END), 0) AS free FROM clean GROUP BY "YearMonth")
SELECT "YearMonth", {r('amount / nullif(free, 0)')} AS per_free_item, {r('amount / (SELECT sum("Amount") FROM clean) * 100')} AS "share",
  {r('round_even(amount / (SELECT sum("Amount") FROM clean) * 100, 2)')} AS share_2 FROM m""",
}
