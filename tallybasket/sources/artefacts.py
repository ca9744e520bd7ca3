"""Folders of features, models and reports, as tables, JSON rows and, for components, Spark ML writers.

Layout: ``features/`` holds the tables ``scaled``, ``full``, ``scaler``, ``clustered`` and the
rows ``metadata`` and ``cleaning``; ``model/`` the table ``kmeans`` of centres, the ``pca_2d`` and ``pca_3d`` models and the row
``metadata``. A missing folder raises when it is read.
"""

from __future__ import annotations

from pyspark.ml.feature import PCAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tallybasket.operators import kmeans
from tallybasket.operators.preparation import Scaler, feature_metadata
from tallybasket.operators.scoring import Artefacts

MODEL_METADATA = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("n_clusters", T.IntegerType()),
        T.StructField("random_state", T.IntegerType()),
        T.StructField("n_features", T.IntegerType()),
        T.StructField("inertia", T.DoubleType()),
        T.StructField("cluster_centers", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("centre_order", T.ArrayType(T.IntegerType())),
        T.StructField("feature_means", T.ArrayType(T.DoubleType())),
    ]
)


def save_features(folder: str, scaled: DataFrame, full: DataFrame, parameters: DataFrame) -> None:
    scaled.write.mode("overwrite").parquet(f"{folder}/features/scaled")
    full.write.mode("overwrite").parquet(f"{folder}/features/full")
    parameters.coalesce(1).write.mode("overwrite").parquet(f"{folder}/features/scaler")
    feature_metadata(parameters, scaled).write.mode("overwrite").json(f"{folder}/features/metadata")


CLEANING_REPORT = (
    "audit struct<rows_in: long, removed_missing_customer: long, removed_cancellations: long, removed_no_quantity: long, rows_out: long, "
    "removed_total: long, retention_pct: double>, checks array<struct<check: string, status: string, n: long, message: string>>, "
    "outliers struct<q1: double, q3: double, iqr: double, lower_bound: double, upper_bound: double, n_outliers: long, n_rows: long>"
)


def save_cleaning_report(folder: str, audit: DataFrame, checks: DataFrame, outliers: DataFrame) -> None:
    """One JSON row: the audit, the four checks and the outlier fences."""
    report = audit.select(F.struct("*").alias("audit")).select(
        "audit",
        checks.agg(F.sort_array(F.collect_list(F.struct("*")))).scalar().alias("checks"),
        outliers.select(F.struct("*")).scalar().alias("outliers"),
    )
    save_report(report, f"{folder}/features/cleaning")


def load_cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(CLEANING_REPORT).json(f"{folder}/features/cleaning")


def load_features(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, Scaler]:
    """Scaled matrix, full features and scaler."""
    scaled = spark.read.parquet(f"{folder}/features/scaled")
    full = spark.read.parquet(f"{folder}/features/full")
    return scaled, full, load_scaler(spark, folder)


def load_scaler(spark: SparkSession, folder: str) -> Scaler:
    return Scaler.from_table(spark.read.parquet(f"{folder}/features/scaler"))


def model_metadata(spark: SparkSession, fit: kmeans.Fit, feature_means: list[float] | None = None) -> DataFrame:
    """One row about a fitted model. ``n_clusters`` is the k that was fitted, centres are in segment order."""
    row = ("KMeans", fit.k, kmeans.SEED, len(fit.cols), fit.inertia, fit.centres, fit.order, feature_means)
    return spark.createDataFrame([row], MODEL_METADATA)


def save_model(folder: str, fit: kmeans.Fit, pca: dict[int, tuple[PCAModel, kmeans.Projection]], spark: SparkSession) -> None:
    centres = spark.createDataFrame(list(enumerate(fit.fitted)), "fitted int, centre array<double>")
    centres.coalesce(1).write.mode("overwrite").parquet(f"{folder}/model/kmeans")
    means = None
    for n, (model, projection) in pca.items():
        model.write().overwrite().save(f"{folder}/model/pca_{n}d")
        means = projection.means
    model_metadata(spark, fit, means).write.mode("overwrite").json(f"{folder}/model/metadata")


def load_model_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MODEL_METADATA).json(f"{folder}/model/metadata")


def save_clustered(folder: str, clustered: DataFrame) -> None:
    clustered.write.mode("overwrite").parquet(f"{folder}/features/clustered")


def load_clustered(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/features/clustered")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(f"{path}/metadata")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def load_artefacts(spark: SparkSession, folder: str) -> Artefacts:
    """Model, scaler and, where they were saved, the projections."""
    fitted = [r["centre"] for r in spark.read.parquet(f"{folder}/model/kmeans").orderBy("fitted").collect()]
    scaler = load_scaler(spark, folder)
    saved = load_model_metadata(spark, folder).first()
    found = {}
    for n in (2, 3):
        path = f"{folder}/model/pca_{n}d"
        if _exists(spark, path):
            found[n] = kmeans.projection_of(PCAModel.load(path), scaler.names, saved["feature_means"])
    centres = kmeans.ordered_centres(fitted, saved["centre_order"])
    return Artefacts(centres, scaler, found.get(2), found.get(3))


def save_report(df: DataFrame, path: str) -> None:
    """A report row as one line of JSON."""
    df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def load_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)
