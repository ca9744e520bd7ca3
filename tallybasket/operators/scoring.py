"""Scoring of customers against a trained model, as one plan without Python functions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybasket.operators import features, kmeans, preparation
from tallybasket.operators.segments import with_segment_label


@dataclass(frozen=True)
class Artefacts:
    """What a trained model leaves for scoring; a few numbers per cluster and feature."""

    centres: list[list[float]]
    scaler: preparation.Scaler
    pca_2d: kmeans.Projection | None = None
    pca_3d: kmeans.Projection | None = None

    @property
    def feature_names(self) -> list[str]:
        return self.scaler.names


def model_inputs(rows: DataFrame, artefacts: Artefacts, as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Scaled features of each customer, in the model's order."""
    names = artefacts.feature_names
    built = preparation.with_logs(features.scoring_features(rows, as_of), only=names)
    return preparation.scale_features(preparation.align_to_model(built, names), artefacts.scaler)


def score_customers(
    rows: DataFrame,
    artefacts: Artefacts,
    dim: DataFrame,
    as_of: dt.datetime | Column | None = None,
    include_metadata: bool = True,
) -> DataFrame:
    """Segment, name, distance and scaled inputs per customer.

    PCA columns come only with ``include_metadata``; three dimensions only beside two.
    """
    return score_inputs(model_inputs(rows, artefacts, as_of), artefacts, dim, include_metadata)


def score_inputs(inputs: DataFrame, artefacts: Artefacts, dim: DataFrame, include_metadata: bool = True) -> DataFrame:
    """The scores of ``score_customers`` from scaled inputs."""
    names = artefacts.feature_names
    scored = kmeans.assign_clusters(inputs, names, artefacts.centres)
    plane, space = artefacts.pca_2d, artefacts.pca_3d
    extra: list[str] = []
    if include_metadata and plane is not None:
        for projection in (plane, space):
            if projection is not None:
                scored = kmeans.project(scored, projection)
                extra += list(projection.columns())
    named = with_segment_label(scored, dim)
    return named.select(
        "CustomerID",
        F.col("Cluster").alias("Segment"),
        "Segment_Name",
        *extra,
        "Distance_to_Center",
        *[F.col(c).alias(f"Feature_{c}") for c in names],
    )


def segment_counts(scored: DataFrame) -> DataFrame:
    counts = scored.groupBy("Segment_Name").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "Segment_Name")


def batch_summary(scored: DataFrame) -> DataFrame:
    """One row: customers, a map of segment sizes, and the mean distance to the nearest centre.

    The map is built from one row per segment, after counting.
    """
    per_segment = scored.groupBy("Segment_Name").agg(
        F.count(F.lit(1)).alias("count"), F.sum("Distance_to_Center").alias("distance")
    )
    return per_segment.agg(
        F.sum("count").alias("total_customers"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("Segment_Name", "count")))).alias("segment_distribution"),
        F.try_divide(F.sum("distance"), F.sum("count").cast("double")).alias("avg_distance_to_center"),
    )


def sample_assignments(scored: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows by customer id."""
    return scored.orderBy("CustomerID").limit(rows)


def model_information(artefacts: Artefacts, dim: DataFrame, inertia: float | None) -> DataFrame:
    """One row about the model; names as a map from cluster id."""
    names = F.map_from_entries(F.array_sort(F.collect_list(F.struct("Cluster", "Segment_Name"))))
    return dim.agg(names.alias("segment_names")).select(
        F.lit("KMeans").alias("model_type"),
        F.lit(len(artefacts.centres)).alias("n_clusters"),
        F.lit(len(artefacts.feature_names)).alias("n_features"),
        F.lit(inertia).cast("double").alias("inertia"),
        "segment_names",
    )
