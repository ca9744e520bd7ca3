"""The four jobs: features, training, batch scoring, report. Jobs hand over through folders."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybasket.functions import columns as fx
from tallybasket.operators import cleaning, clusters, features, kmeans, metrics, preparation, profile, scoring, segments
from tallybasket.operators.comparison import compare
from tallybasket.schemas import SCORING_COLUMNS, require_columns
from tallybasket.session import materialize, scratch_scope
from tallybasket.sources import artefacts, transactions


#: What the features and the outlier report need of a clean row.
FEATURE_INPUTS = ["CustomerID", "InvoiceNo", "StockCode", "InvoiceDate", "Quantity", "Amount"]


def feature_job(raw: DataFrame, folder: str, reference_date: dt.datetime | None = None) -> None:
    """Raw transactions to the feature tables and the cleaning report.

    The raw rows are read once: the clean rows are written, which counts what cleaning removes and what the checks find, and
    everything else reads them.
    """
    spark = raw.sparkSession
    with scratch_scope(spark):
        watched, audit, checks = cleaning.observed_cleaning(raw)
        clean = materialize(watched.select(*FEATURE_INPUTS), "clean")
        artefacts.save_cleaning_report(
            folder, cleaning.observed_audit(spark, audit), cleaning.observed_checks(spark, checks), cleaning.outlier_report(clean)
        )
        full = materialize(features.customer_features(clean, reference_date), "features")
        matrix = materialize(preparation.unscaled_matrix(full), "matrix")
        names = [c for c in matrix.columns if c != "CustomerID"]
        parameters = materialize(preparation.scaler_parameters(matrix, names), "scaler")
        scaled = preparation.scale_features(matrix, preparation.Scaler.from_table(parameters))
        artefacts.save_features(folder, scaled, full, parameters)


@dataclass(frozen=True)
class Training:
    fit: kmeans.Fit
    scores: DataFrame
    clustered: DataFrame
    explained: dict[int, float]


def find_optimal_clusters(
    spark: SparkSession, folder: str, max_clusters: int = 10, restarts: int = kmeans.RESTARTS, **settings
) -> tuple[DataFrame, int, int | None]:
    """The sweep over k, the elbow's k and the k with the best silhouette (None if the sweep leaves it out).

    ``settings`` as in ``kmeans.sweep``.
    """
    scaled, _, scaler = artefacts.load_features(spark, folder)
    with scratch_scope(spark):
        found = kmeans.sweep(scaled, scaler.names, max_clusters, restarts, **settings)
        # One row for each k.
        table = spark.createDataFrame(found.collect(), found.schema)
    best = metrics.best_silhouette(table).first()
    return table, metrics.elbow(table).first()["elbow_k"], best and best["best_silhouette_k"]


def best_training_job(spark: SparkSession, folder: str, max_clusters: int = 10, restarts: int = kmeans.RESTARTS) -> Training:
    """Train with the k whose silhouette was best in the sweep."""
    _, _, best = find_optimal_clusters(spark, folder, max_clusters, restarts)
    return training_job(spark, folder, best, restarts)


def training_job(
    spark: SparkSession, folder: str, k: int = 4, restarts: int = kmeans.RESTARTS, with_silhouette: bool = True, **settings
) -> Training:
    """Fit, measure, project and save; clusters are numbered by mean spend, greatest first.

    ``settings`` go to ``kmeans.fit_kmeans``, such as ``starts``: given starting centres.

    Fewer distinct customers than ``k`` give fewer clusters; the number fitted is the one saved.
    The silhouette is quadratic in the number of customers and can be left out.
    """
    scaled, full, scaler = artefacts.load_features(spark, folder)
    names = scaler.names
    missing = clusters.unmatched_labels(full, scaled)
    if not missing.isEmpty():
        raise ValueError("the scaled table holds customers that the full table lacks")
    with scratch_scope(spark):
        fit = kmeans.fit_kmeans(scaled, names, k, restarts=restarts, **settings)
        as_fitted = kmeans.assign_clusters(scaled, names, fit.centres)
        fit = replace(fit, order=kmeans.spend_order(clusters.attach_clusters(full, as_fitted), fit.k))
        labelled = materialize(kmeans.assign_clusters(scaled, names, fit.centres), "labels")
        silhouette = F.lit(None).cast("double")
        if with_silhouette:
            silhouette = metrics.silhouettes(labelled, ["Cluster"], names).select("silhouette").scalar()
        measured = metrics.measures(labelled, ["Cluster"], names)
        scores = spark.createDataFrame([(fit.k, fit.inertia)], "k int, inertia double").select(
            "*",
            silhouette.alias("silhouette"),
            measured.select("davies_bouldin").scalar().alias("davies_bouldin"),
            measured.select("calinski_harabasz").scalar().alias("calinski_harabasz"),
        )
        pca = {n: kmeans.fit_pca(scaled, names, n) for n in (2, 3)}
        artefacts.save_model(folder, fit, pca, spark)
        artefacts.save_clustered(folder, clusters.attach_clusters(full, labelled))
        scores = spark.createDataFrame(scores.collect(), scores.schema)  # one row
    explained = {n: sum(p.explained) for n, (_, p) in pca.items()}
    return Training(fit, scores, artefacts.load_clustered(spark, folder), explained)


def compare_job(spark: SparkSession, folder: str, k: int = 4) -> tuple[DataFrame, DataFrame]:
    scaled, _, scaler = artefacts.load_features(spark, folder)
    return compare(scaled, scaler.names, k)


def score_rows(
    rows: DataFrame,
    folder: str,
    dim: DataFrame | None = None,
    as_of: dt.datetime | Column | None = None,
    include_metadata: bool = True,
) -> DataFrame:
    """Scores of transaction rows whose date may be text."""
    require_columns(rows, SCORING_COLUMNS)
    spark = rows.sparkSession
    if rows.schema["InvoiceDate"].dataType.simpleString() == "string":
        rows = rows.withColumn("InvoiceDate", fx.parse_timestamp(F.col("InvoiceDate")))
    dim = segments.segment_dimension(spark) if dim is None else dim
    return scoring.score_customers(rows, artefacts.load_artefacts(spark, folder), dim, as_of, include_metadata)


@dataclass(frozen=True)
class BatchResult:
    summary: DataFrame
    sample: DataFrame
    path: str


def score_csv_job(
    spark: SparkSession, source: str, folder: str, target: str, as_of: dt.datetime | Column | None = None
) -> BatchResult:
    """Score a CSV file into a CSV folder; summary and sample read the written scores."""
    rows = transactions.read_scoring_csv(spark, source)
    scored = materialize(score_rows(rows, folder, as_of=as_of, include_metadata=False), "scores")
    scored.write.mode("overwrite").option("header", True).csv(target)
    return BatchResult(scoring.batch_summary(scored), scoring.sample_assignments(scored), target)


def segment_info(spark: SparkSession, folder: str, segment_id: int | None = None) -> DataFrame:
    """Segment sizes and means, or names only while no clustered table exists."""
    dim = segments.segment_dimension(spark)
    try:
        clustered = artefacts.load_clustered(spark, folder)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return segments.segment_info_without_data(dim, segment_id)
    return segments.segment_info(clustered, dim, segment_id)


def model_info(spark: SparkSession, folder: str) -> DataFrame:
    inertia = artefacts.load_model_metadata(spark, folder).first()["inertia"]
    return scoring.model_information(artefacts.load_artefacts(spark, folder), segments.segment_dimension(spark), inertia)


def report_job(spark: SparkSession, folder: str, date: dt.date | None = None) -> DataFrame:
    """Write the full report and its summary as JSON; gives the report row."""
    with scratch_scope(spark):
        report = profile.full_report(artefacts.load_clustered(spark, folder), segments.segment_dimension(spark), date)
        artefacts.save_report(report, f"{folder}/results/segment_profiling_report")
    written = artefacts.load_report(spark, f"{folder}/results/segment_profiling_report")
    artefacts.save_report(written.select("executive_summary.*"), f"{folder}/results/executive_summary")
    return written
