"""Scoring, saved artefacts, jobs and the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cleaning, fits
from checks import tables as t
from checks.clusterings import GIVEN_LOADINGS, PCA_NAMES
from checks.customers import ALL_FEATURES_SQL, FINAL, SCORING_SQL, scaled_sql
from checks.profiles import _DIST, _REV, DIM_SQL
from checks.tables import r
from tallybasket.operators import kmeans, preparation, profile, scoring, segments
from tallybasket.plans import jobs
from tallybasket.schemas import SCORING_COLUMNS, require_columns
from tallybasket.session import materialize, scratch_path
from tallybasket.sources import artefacts, transactions
from tallybasket.streaming import continuous_scoring as stream


def event_matrix(spark, sf_dir):
    """Scoring features of the events before scaling."""
    from tallybasket.operators.features import scoring_features

    built = preparation.with_logs(scoring_features(t.ev(spark, sf_dir), t.AS_OF), only=FINAL)
    return materialize(preparation.align_to_model(built, FINAL), "event-matrix")


def given_model(spark, sf_dir):
    """A model from the events themselves: scaler of their matrix, and the scaled means of three groups of users."""
    rows = event_matrix(spark, sf_dir)
    scaler = preparation.Scaler.from_table(preparation.scaler_parameters(rows, FINAL))
    scaled = preparation.scale_features(rows, scaler)
    means = scaled.groupBy((F.col("CustomerID") % 3).alias("g")).agg(*[F.avg(c).alias(c) for c in FINAL]).orderBy("g")
    centres = [[row[c] for c in FINAL] for row in means.collect()]
    plane = kmeans.Projection(FINAL, [0.0] * 6, GIVEN_LOADINGS, [])
    space = kmeans.Projection(FINAL, [0.0] * 6, [*GIVEN_LOADINGS, [0.0, 0.0, 0.0, 0.0, 0.6, 0.8]], [])
    return scoring.Artefacts(centres, scaler, plane, space)


def scored(spark, sf_dir, metadata=True):
    dim = segments.segment_dimension(spark)
    return scoring.score_customers(t.ev(spark, sf_dir), given_model(spark, sf_dir), dim, t.AS_OF, metadata)


def summary(spark, sf_dir):
    got = scoring.batch_summary(scored(spark, sf_dir))
    sizes = F.array_join(F.transform(F.map_entries("segment_distribution"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
    return t.comparable(got.withColumn("segment_distribution", sizes))


def model_row(spark, sf_dir):
    got = scoring.model_information(given_model(spark, sf_dir), segments.segment_dimension(spark), None)
    return got.select("model_type", "n_clusters", "n_features", F.to_json("segment_names").alias("segment_names"))


def trained_folder(spark, sf_dir):
    """Feature and training job over the transactions, in a new folder; four clusters from given centres."""
    folder = scratch_path(spark, "trained")
    jobs.feature_job(t.tx(spark, sf_dir), folder)
    scaled, _, scaler = artefacts.load_features(spark, folder)
    return folder, jobs.training_job(spark, folder, k=4, starts=fits.starts(scaled, scaler.names, 4), **fits.GIVEN)


def feature_folder(spark, sf_dir):
    """Feature job written and read back: scaled beside full features."""
    folder = scratch_path(spark, "features")
    jobs.feature_job(t.tx(spark, sf_dir), folder)
    scaled, full, scaler = artefacts.load_features(spark, folder)
    joined = scaled.select("CustomerID", *[F.col(c).alias(f"Scaled_{c}") for c in scaler.names])
    return t.comparable(joined.join(full.select("CustomerID", "Recency", "Monetary"), "CustomerID"))


def scaled_sink(spark, sf_dir):
    folder = scratch_path(spark, "features")
    jobs.feature_job(t.tx(spark, sf_dir), folder)
    return t.comparable(artefacts.load_features(spark, folder)[0])


def full_sink(spark, sf_dir):
    folder = scratch_path(spark, "features")
    jobs.feature_job(t.tx(spark, sf_dir), folder)
    return t.comparable(artefacts.load_features(spark, folder)[1])


def cleaning_report(part):
    """A part of the cleaning report that the feature job left beside the features."""

    def run(spark, sf_dir):
        folder = scratch_path(spark, "features")
        jobs.feature_job(t.tx(spark, sf_dir), folder)
        report = artefacts.load_cleaning_report(spark, folder)
        rows = report.select(F.inline("checks")) if part == "checks" else report.select(f"{part}.*")
        return t.comparable(rows)

    return run


def month_table(spark, sf_dir):
    """Clean rows written as a table by month and read back."""
    path = transactions.write_clean_table(t.clean(spark, sf_dir), scratch_path(spark, "months"))
    back = transactions.read_parquet_table(spark, path)
    return t.comparable(back.groupBy("YearMonth").agg(F.count(F.lit(1)).alias("n"), F.sum("Amount").alias("amount")), 2)


def model_metadata(spark, sf_dir):
    """The metadata row, one row for each centre."""
    folder, _ = trained_folder(spark, sf_dir)
    meta = artefacts.load_model_metadata(spark, folder)
    flat = meta.select("*", F.posexplode("cluster_centers").alias("Cluster", "c"))
    centre = [F.col("c")[i].alias(c) for i, c in enumerate(FINAL)]
    return t.comparable(flat.select("model_type", "n_clusters", "random_state", "n_features", "inertia", "Cluster", *centre))


def saved_projection(spark, sf_dir):
    """Scaled customers projected by the saved and loaded components."""
    folder, _ = trained_folder(spark, sf_dir)
    scaled, _, _ = artefacts.load_features(spark, folder)
    model = artefacts.load_artefacts(spark, folder)
    return t.comparable(kmeans.project(kmeans.project(scaled, model.pca_2d), model.pca_3d).select("CustomerID", *PCA_NAMES))


def clustered_sink(spark, sf_dir):
    """Clustered customers as the training job left them, their cluster included."""
    folder, _ = trained_folder(spark, sf_dir)
    return t.comparable(artefacts.load_clustered(spark, folder))


def trained_scores(spark, sf_dir):
    """All events scored by the loaded model."""
    folder, _ = trained_folder(spark, sf_dir)
    return t.comparable(jobs.score_rows(t.ev(spark, sf_dir), folder, as_of=t.AS_OF))


def training_scores(spark, sf_dir):
    """The measures of the training's fit."""
    _, trained = trained_folder(spark, sf_dir)
    digits = {"inertia": 4, "silhouette": 6, "davies_bouldin": 6, "calinski_harabasz": 3}
    rounded = [F.round(F.col(c) + F.lit(t.shift(d)), d).alias(c) for c, d in digits.items()]
    return trained.scores.select(F.col("k").cast("long").alias("k"), *rounded)


def best_training(spark, sf_dir):
    """Training with the k that the sweep's silhouette chose: k and its fit, measured again."""
    folder = scratch_path(spark, "best")
    jobs.feature_job(t.tx(spark, sf_dir), folder)
    trained = jobs.best_training_job(spark, folder, max_clusters=6, restarts=3)
    return t.comparable(trained.scores)


def model_files(spark, sf_dir):
    """Saved model read back: metadata, and the centre and the number of customers of each cluster."""
    folder, _ = trained_folder(spark, sf_dir)
    scaled, _, scaler = artefacts.load_features(spark, folder)
    model = artefacts.load_artefacts(spark, folder)
    sizes = kmeans.assign_clusters(scaled, scaler.names, model.centres).groupBy("Cluster").agg(F.count(F.lit(1)).alias("n"))
    meta = artefacts.load_model_metadata(spark, folder).select("model_type", "n_clusters", "n_features", "inertia")
    centres = spark.createDataFrame([(i, *c) for i, c in enumerate(model.centres)], "Cluster int, " + ", ".join(f"{c} double" for c in FINAL))
    facts = meta.select(F.struct("*")).scalar()
    return t.comparable(centres.join(sizes, "Cluster", "left").select("*", *[facts[c].alias(c) for c in meta.columns]))


def renumbered(spark, sf_dir):
    """Clusters numbered by spend: customers, spend and mean spend of each."""
    _, trained = trained_folder(spark, sf_dir)
    means = trained.clustered.groupBy("Cluster").agg(
        F.count(F.lit(1)).alias("n"), F.avg("Monetary").alias("mean"), F.sum("Monetary").alias("spend")
    )
    return t.comparable(means, 2)


def _events_csv(spark, sf_dir):
    path = scratch_path(spark, "events-csv")
    rows = t.ev(spark, sf_dir).select(
        "CustomerID", F.date_format("InvoiceDate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("InvoiceDate"), "Amount", "Quantity"
    )
    rows.write.option("header", True).csv(path)
    return path


def batch_job(spark, sf_dir):
    """The CSV job with the trained model: file in, file out, read back."""
    folder, _ = trained_folder(spark, sf_dir)
    result = jobs.score_csv_job(spark, _events_csv(spark, sf_dir), folder, scratch_path(spark, "scores-csv"), t.AS_OF)
    back = spark.read.option("header", True).csv(result.path)
    kinds = {"CustomerID": "long", "Segment": "long", "Segment_Name": "string"}
    return t.comparable(back.select(*[F.col(c).cast(kinds.get(c, "double")).alias(c) for c in back.columns]))


def batch_segments(spark, sf_dir):
    """Customers per segment of the CSV job."""
    return batch_job(spark, sf_dir).groupBy("Segment", "Segment_Name").agg(F.count(F.lit(1)).alias("customers"))


_REPORT = (
    "distribution struct<total_customers: long, segments: map<string, struct<`count`: long, percentage: double>>>, "
    "revenue map<string, struct<Total_Revenue: double, Avg_Revenue_per_Customer: double, Revenue_Percentage: double>>, "
    "executive_summary struct<project_overview: struct<segments_identified: long>>"
)


def report_files(spark, sf_dir):
    """The written JSON of the report, figure by figure, one row for each segment."""
    folder, _ = trained_folder(spark, sf_dir)
    jobs.report_job(spark, folder)
    text = spark.read.text(f"{folder}/results/segment_profiling_report")
    report = text.select(F.from_json("value", _REPORT).alias("r")).select("r.*")
    rows = report.select(
        "distribution.total_customers", "executive_summary.project_overview.segments_identified", "revenue", F.explode("distribution.segments").alias("Segment_Name", "d")
    ).withColumn("m", F.col("revenue")[F.col("Segment_Name")])
    return t.comparable(rows.select("total_customers", "segments_identified", "Segment_Name", "d.*", "m.*"))


def example_rows(spark, sf_dir):
    """The example rows scored by the trained model: the customers that a new user sees first."""
    folder, _ = trained_folder(spark, sf_dir)
    got = jobs.score_rows(transactions.example_transactions(spark), folder, as_of=t.AS_OF, include_metadata=False)
    return t.comparable(got)


def column_check(spark, sf_dir):
    """What the check of required columns says of the events when columns are left out, beside the events' number."""
    rows = t.ev(spark, sf_dir)
    said = []
    for absent in ([], ["Quantity"], ["Amount", "InvoiceDate"]):
        try:
            require_columns(rows.drop(*absent), SCORING_COLUMNS)
            said.append((",".join(absent), None))
        except ValueError as problem:
            said.append((",".join(absent), str(problem)))
    count = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return spark.createDataFrame(said, "absent string, message string").withColumn("rows", count)


def dated(spark, sf_dir):
    """The dates of purchases as text, and whether the default date of a summary is today's."""
    rows = t.ev(spark, sf_dir).groupBy(F.date_format("InvoiceDate", "yyyy-MM-dd").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    distribution = spark.createDataFrame([("A", 1, 1, 100.0)], "Segment_Name string, total_customers long, count long, percentage double")
    revenue = spark.createDataFrame([("A", 1.0, 100.0, 1.0)], "Segment_Name string, Total_Revenue double, Revenue_Percentage double, Avg_Revenue_per_Customer double")
    today = profile.executive_summary(distribution, revenue).select("date").scalar() == F.date_format(F.current_date(), "yyyy-MM-dd")
    return rows.withColumn("default_is_today", today)


def info_without_data(spark, sf_dir):
    """Segment information before any training: names and descriptions of the segments that the events' users are assigned to."""
    folder, _ = trained_folder(spark, sf_dir)
    taken = jobs.score_rows(t.ev(spark, sf_dir), folder, as_of=t.AS_OF).select(F.col("Segment").alias("segment_id")).distinct()
    info = jobs.segment_info(spark, scratch_path(spark, "nowhere"))
    return t.comparable(info.join(taken, "segment_id", "left_semi"))


def _stream_batches(spark, sf_dir, include_metadata):
    """All events in three batches, so that most customers return, by the restarted stream."""
    model = given_model(spark, sf_dir)
    folder, source = scratch_path(spark, "stream"), scratch_path(spark, "stream-source")
    rows = t.ev(spark, sf_dir).select(
        "CustomerID", F.date_format("InvoiceDate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("InvoiceDate"), "Amount", "Quantity", "InvoiceNo"
    )
    for part in range(3):
        own = rows.where(F.pmod(F.xxhash64("InvoiceNo"), F.lit(3)) == part).drop("InvoiceNo")
        own.write.mode("append").option("header", True).csv(source)
        stream.start_scoring(stream.read_transactions(spark, source), folder, model, t.AS_OF, include_metadata).awaitTermination()
    return t.comparable(stream.current_scores(spark, folder))


def streamed(spark, sf_dir):
    """In the end the same scores as in one batch."""
    return _stream_batches(spark, sf_dir, False).select("CustomerID", "Segment", "Segment_Name", "Distance_to_Center")


def streamed_columns(spark, sf_dir):
    """The same with components and features."""
    return _stream_batches(spark, sf_dir, True)


def quarantined(spark, sf_dir):
    """Refused rows by reason after validation of all order lines, from the quarantine table."""
    from tallybasket.operators.cleaning import split_scoring_rows, with_amount

    rows = with_amount(t.tx(spark, sf_dir)).withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd"))
    _, refused = split_scoring_rows(rows)
    return refused.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "i17_score_customers": lambda s, d: t.comparable(scored(s, d)),
    "b21_feature_columns": lambda s, d: t.comparable(scored(s, d, False).select("CustomerID", *[f"Feature_{c}" for c in FINAL])),
    "b22_without_metadata": lambda s, d: t.comparable(scored(s, d, False).select("CustomerID", "Segment", "Segment_Name", "Distance_to_Center")),
    "i12_projection_at_scoring": lambda s, d: t.comparable(
        scored(s, d).select("CustomerID", "PCA1_2D", "PCA2_2D", "PCA1_3D", "PCA2_3D", "PCA3_3D")),
    "d23_segment_counts": lambda s, d: t.comparable(scoring.segment_counts(scored(s, d, False))),
    "d24_batch_summary": summary,
    "d26_model_information": model_row,
    "f3_sample_assignments": lambda s, d: t.comparable(
        scoring.sample_assignments(scored(s, d, False)).select("CustomerID", "Segment", "Distance_to_Center")),
    "b18_quarantine": quarantined,
    "a4_clean_table_by_month": month_table,
    "a5_scaled_sink": scaled_sink,
    "a6_full_sink": full_sink,
    "a9_feature_tables": feature_folder,
    "d11_saved_outliers": cleaning_report("outliers"),
    "d12_saved_checks": cleaning_report("checks"),
    "d13_saved_audit": cleaning_report("audit"),
    "a11_model_metadata": model_metadata,
    "a12_saved_projection": saved_projection,
    "a13_clustered_sink": clustered_sink,
    "a16_loaded_model": trained_scores,
    "a10_model_files": model_files,
    "a15_report_files": report_files,
    "i13_training": training_scores,
    "i13_stable_clusters": renumbered,
    "i13_best_training": best_training,
    "i18_batch_job": batch_job,
    "i18_batch_segments": batch_segments,
    "a17_info_without_data": info_without_data,
    "a20_example_rows": example_rows,
    "b14_required_columns": column_check,
    "h7_dates": dated,
    "j1_stream": streamed,
    "j1_stream_columns": streamed_columns,
}

_SCALED = ", ".join(
    f'("{c}" - (SELECT avg("{c}") FROM m)) / (SELECT CASE WHEN stddev_pop("{c}") = 0 THEN 1 ELSE stddev_pop("{c}") END FROM m) AS "{c}"'
    for c in FINAL
)
_X = "[" + ", ".join(f'"{c}"' for c in FINAL) + "]"
_NAMES = "CASE label " + " ".join(f"WHEN {i} THEN '{row[1]}'" for i, row in enumerate(segments.SEGMENTS)) + " ELSE 'Cluster_' || label END"
SCORED = (
    SCORING_SQL
    + f""", m AS (SELECT "CustomerID", CAST("Recency" AS DOUBLE) AS "Recency", ln(1 + "Frequency") AS "Log_Frequency",
  ln(1 + "Monetary") AS "Log_Monetary", ln(1 + "AvgTransactionValue") AS "Log_AvgTransactionValue",
  CAST("CustomerLifetime" AS DOUBLE) AS "CustomerLifetime", "PurchaseFrequency" FROM sfeat),
z AS (SELECT "CustomerID", {_SCALED} FROM m), p AS (SELECT *, {_X} AS x FROM z),
cen AS (SELECT CAST("CustomerID" % 3 AS BIGINT) AS label, [{", ".join(f'avg("{c}")' for c in FINAL)}] AS c FROM z GROUP BY 1),
best AS (SELECT "CustomerID", arg_min(label, list_distance(x, c)) AS label, min(list_distance(x, c)) AS d FROM p, cen GROUP BY "CustomerID"),
scored AS (SELECT p.*, label, d, {_NAMES} AS name FROM p JOIN best ON p."CustomerID" = best."CustomerID")"""
)


def _projection(weights):
    return r(" + ".join(f'"{c}" * {w}' for c, w in zip(FINAL, weights)))


_SPACE = [*GIVEN_LOADINGS, [0.0, 0.0, 0.0, 0.0, 0.6, 0.8]]
_PCA = ", ".join(
    [f'{_projection(w)} AS "PCA{i}_2D"' for i, w in enumerate(GIVEN_LOADINGS, 1)]
    + [f'{_projection(w)} AS "PCA{i}_3D"' for i, w in enumerate(_SPACE, 1)]
)
_FEATURES = ", ".join(r(f'"{c}"') + f' AS "Feature_{c}"' for c in FINAL)
_CORE = f'"CustomerID", label AS "Segment", name AS "Segment_Name", {r("d")} AS "Distance_to_Center"'

_EXAMPLE = """ev AS (SELECT * FROM (VALUES (12345, TIMESTAMP '2023-12-01 10:30:00', 150.5::DOUBLE, 3), (12345, TIMESTAMP '2023-11-15 14:20:00', 75.25, 2),
  (67890, TIMESTAMP '2023-10-10 09:15:00', 300.0, 5), (67890, TIMESTAMP '2023-09-05 16:45:00', 120.75, 2)) AS e("CustomerID", "InvoiceDate", "Amount", "Quantity"))"""
_MEASURED = f"{fits.TRAINED}, {fits.measures_sql(4)}"
ORACLES = {
    "a10_model_files": f"""{fits.TRAINED} SELECT CAST(tcen."Cluster" AS BIGINT) AS "Cluster", count(id) AS n, {fits.CENTRE_COLUMNS.replace("c[", "any_value(c)[")},
  'KMeans' AS model_type, CAST(4 AS BIGINT) AS n_clusters, CAST({len(FINAL)} AS BIGINT) AS n_features,
  {r('(SELECT sum(d * d) FROM trained)')} AS inertia FROM tcen LEFT JOIN trained ON trained."Cluster" = tcen."Cluster" GROUP BY tcen."Cluster" """,
    "a11_model_metadata": f"""{fits.TRAINED} SELECT 'KMeans' AS model_type, (SELECT count(*) FROM tcen) AS n_clusters, CAST(42 AS BIGINT) AS random_state,
  CAST({len(FINAL)} AS BIGINT) AS n_features, {r('(SELECT sum(d * d) FROM trained)')} AS inertia, CAST("Cluster" AS BIGINT) AS "Cluster",
  {fits.CENTRE_COLUMNS} FROM tcen""",
    "a12_saved_projection": f'{fits.TRAINED}, {fits.pca_sql(3)} SELECT id AS "CustomerID", {fits.PCA_COLUMNS} FROM trained',
    "a16_loaded_model": f"{fits.TRAINED_SCORES} SELECT {fits.SCORE_CORE}, {fits.PCA_COLUMNS}, {fits.SCORE_FEATURES} FROM scored",
    "i13_training": f"{_MEASURED} SELECT * FROM measured",
    "i13_stable_clusters": f"""{fits.TRAINED} SELECT CAST("Cluster" AS BIGINT) AS "Cluster", count(*) AS n, {r('avg("Monetary")', 2)} AS mean,
  {r('sum("Monetary")', 2)} AS spend FROM trained JOIN feat ON id = "CustomerID" GROUP BY "Cluster" """,
    "i18_batch_job": f"{fits.TRAINED_SCORES} SELECT {fits.SCORE_CORE}, {fits.SCORE_FEATURES} FROM scored",
    "i18_batch_segments": f"""{fits.TRAINED_SCORES} SELECT CAST("Cluster" AS BIGINT) AS "Segment", name AS "Segment_Name", count(*) AS customers
  FROM scored GROUP BY ALL""",
    "a17_info_without_data": f"""{fits.TRAINED_SCORES}, {DIM_SQL} SELECT CAST("Cluster" AS BIGINT) AS segment_id, "Segment_Name" AS segment_name, description,
  CAST(NULL AS BIGINT) AS size, CAST(NULL AS DOUBLE) AS percentage, CAST(NULL AS DOUBLE) AS avg_recency, CAST(NULL AS DOUBLE) AS avg_frequency,
  CAST(NULL AS DOUBLE) AS avg_monetary FROM dim WHERE "Cluster" IN (SELECT "Cluster" FROM scored)""",
    "a20_example_rows": f"{fits.TRAINED_SCORES.replace(t.EV_SQL, _EXAMPLE)} SELECT {fits.SCORE_CORE}, {fits.SCORE_FEATURES} FROM scored",
    "b14_required_columns": """SELECT *, (SELECT count(*) FROM events) AS "rows" FROM (VALUES ('', NULL), ('Quantity', 'Missing required columns: [''Quantity'']'),
  ('Amount,InvoiceDate', 'Missing required columns: [''InvoiceDate'', ''Amount'']')) AS said(absent, message)""",
    "h7_dates": f"""WITH {t.EV_SQL} SELECT strftime("InvoiceDate", '%Y-%m-%d') AS "date", count(*) AS n, true AS default_is_today FROM ev GROUP BY 1""",
    "i17_score_customers": f"WITH {SCORED} SELECT {_CORE}, {_PCA}, {_FEATURES} FROM scored",
    "b21_feature_columns": f'WITH {SCORED} SELECT "CustomerID", {_FEATURES} FROM scored',
    "b22_without_metadata": f"WITH {SCORED} SELECT {_CORE} FROM scored",
    "i12_projection_at_scoring": f'WITH {SCORED} SELECT "CustomerID", {_PCA} FROM scored',
    "d23_segment_counts": f'WITH {SCORED} SELECT name AS "Segment_Name", count(*) AS "count" FROM scored GROUP BY name',
    "d24_batch_summary": f"""WITH {SCORED}, g AS (SELECT name, count(*) AS n FROM scored GROUP BY name)
SELECT count(*) AS total_customers, (SELECT string_agg(name || ':' || n, ',' ORDER BY name) FROM g) AS segment_distribution,
  {r('avg(d)')} AS avg_distance_to_center FROM scored""",
    "d26_model_information": f"""WITH {SCORED} SELECT 'KMeans' AS model_type, CAST((SELECT count(*) FROM cen) AS INTEGER) AS n_clusters,
  CAST({len(FINAL)} AS INTEGER) AS n_features, '{{{", ".join(f'"{row[0]}":"{row[1]}"' for row in segments.SEGMENTS).replace(", ", ",")}}}' AS segment_names""",
    "f3_sample_assignments": f"""WITH {SCORED} SELECT "CustomerID", label AS "Segment", {r('d')} AS "Distance_to_Center" FROM scored
  ORDER BY "CustomerID" LIMIT 10""",
    "b18_quarantine": f"""WITH {t.TX_SQL}, x AS (SELECT *, "Quantity" * "UnitPrice" AS "Amount" FROM tx)
SELECT 'missing_customer' AS reason, count(*) AS n FROM x WHERE "CustomerID" IS NULL
UNION ALL SELECT 'amount_not_positive', count(*) FROM x WHERE "Amount" <= 0
UNION ALL SELECT 'quantity_not_positive', count(*) FROM x WHERE "Quantity" <= 0""",
    "j1_stream": f"WITH {SCORED} SELECT {_CORE} FROM scored",
    "a4_clean_table_by_month": f"""WITH {t.CLEAN_SQL} SELECT "YearMonth", count(*) AS n, {r('sum("Amount")', 2)} AS amount FROM clean
  GROUP BY "YearMonth" """,
    "a5_scaled_sink": f"""WITH {scaled_sql(t.FEATURES_SQL)} SELECT "CustomerID", {", ".join(r(f'"{c}"') + f' AS "{c}"' for c in FINAL)} FROM scaled""",
    "a6_full_sink": ALL_FEATURES_SQL,
    "a9_feature_tables": f"""WITH {scaled_sql(t.FEATURES_SQL)} SELECT "CustomerID", {", ".join(r(f's."{c}"') + f' AS "Scaled_{c}"' for c in FINAL)},
  feat."Recency", {r('"Monetary"')} AS "Monetary" FROM scaled s JOIN feat USING ("CustomerID")""",
    "a13_clustered_sink": f"""{fits.TRAINED}, every AS ({ALL_FEATURES_SQL.replace("WITH " + t.FEATURES_SQL, "")}) SELECT every.*, CAST("Cluster" AS BIGINT) AS "Cluster"
  FROM every JOIN trained ON id = "CustomerID" """,
    "a15_report_files": f"""{fits.TRAINED}, {DIM_SQL}, clustered AS (SELECT feat.*, "Cluster" FROM feat JOIN trained ON id = "CustomerID"), {_DIST}, {_REV}
SELECT total_customers, (SELECT count(*) FROM dist) AS segments_identified, dist."Segment_Name", "count", {r("percentage")} AS percentage,
  {r('"Total_Revenue"')} AS "Total_Revenue", {r('"Avg_Revenue_per_Customer"')} AS "Avg_Revenue_per_Customer",
  {r('"Revenue_Percentage"')} AS "Revenue_Percentage" FROM dist JOIN rev ON rev."Segment_Name" = dist."Segment_Name" """,
    "j1_stream_columns": f"WITH {SCORED} SELECT {_CORE}, {_PCA}, {_FEATURES} FROM scored",
}
ORACLES |= {
    "d11_saved_outliers": cleaning.ORACLES["d11_outlier_report"],
    "d12_saved_checks": cleaning.ORACLES["d12_quality_checks"],
    "d13_saved_audit": cleaning.ORACLES["d13_cleaning_audit"],
}
