"""From customer features to the scaled matrix: select, filter, fill, log, scale."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybasket.functions import columns as fx
from tallybasket.operators.quantiles import quantile_row
from tallybasket.schemas import CLUSTERING_FEATURES, SKEWED_FEATURES


def available_features(features: DataFrame) -> list[str]:
    return [c for c in CLUSTERING_FEATURES if c in features.columns]


def select_clustering_features(features: DataFrame) -> DataFrame:
    return features.select("CustomerID", *available_features(features))


def keep_spenders(features: DataFrame) -> DataFrame:
    return features.where(F.col("Monetary") > 0)


def spend_audit(features: DataFrame) -> DataFrame:
    """How many customers spent nothing and leave before clustering."""
    kept = F.coalesce(F.col("Monetary") > 0, F.lit(False))
    return features.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("dropped_zero_spend"),
    )


def missing_values(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values per column and in total, as one row."""
    counts = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    return counts.withColumn("missing_total", total)


def fill_with_medians(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace missing values by the column's exact median.

    One count tells which columns have gaps; medians are computed for those alone.
    """
    gaps = missing_values(features, cols).first()
    gappy = [c for c in cols if gaps[c] > 0]
    filled = {c: F.col(c).cast("double") for c in cols}
    if gappy:
        medians = quantile_row(features, gappy, [0.5]).select(F.struct(*gappy)).scalar()
        filled |= {c: F.coalesce(filled[c], medians.getField(c).getItem(0)) for c in gappy}
    return features.withColumns(filled)


def log_name(col: str) -> str:
    return f"Log_{col}"


def final_feature_names(available: Sequence[str]) -> list[str]:
    """The model's features: each skewed one gives way to its logarithm."""
    return [log_name(c) if c in SKEWED_FEATURES else c for c in available]


def with_logs(features: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Add log1p of the skewed features present; ``only`` restricts to log names a model knows."""
    skewed = [c for c in SKEWED_FEATURES if c in features.columns and (only is None or log_name(c) in only)]
    return features.withColumns({log_name(c): F.log1p(c) for c in skewed}) if skewed else features


def unscaled_matrix(features: DataFrame) -> DataFrame:
    """CustomerID and the final features before scaling."""
    available = available_features(features)
    chosen = keep_spenders(features).select("CustomerID", *available)
    filled = fill_with_medians(chosen, available)
    return with_logs(filled).select("CustomerID", *[F.col(c).cast("double").alias(c) for c in final_feature_names(available)])


def scaler_parameters(matrix: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation per feature: (position, feature, mean, scale).

    A deviation of zero becomes 1, so that applying the scaler only centres the feature.
    """
    stats = matrix.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(c).alias("feature"),
                    F.avg(c).alias("mean"),
                    F.stddev_pop(c).alias("scale"),
                )
                for i, c in enumerate(cols)
            ]
        ).alias("p")
    )
    rows = stats.select(F.inline("p"))
    return rows.withColumn("scale", F.when(F.col("scale") == 0, F.lit(1.0)).otherwise(F.col("scale")))


@dataclass(frozen=True)
class Scaler:
    """Scaler parameters on the driver: two numbers per feature."""

    names: list[str]
    means: list[float]
    scales: list[float]

    @classmethod
    def from_table(cls, parameters: DataFrame) -> Scaler:
        rows = parameters.orderBy("position").collect()
        return cls([r["feature"] for r in rows], [r["mean"] for r in rows], [r["scale"] for r in rows])

    def columns(self) -> dict[str, Column]:
        return {
            name: fx.standardized(F.col(name).cast("double"), mean, scale)
            for name, mean, scale in zip(self.names, self.means, self.scales, strict=True)
        }


def scale_features(matrix: DataFrame, scaler: Scaler) -> DataFrame:
    return matrix.withColumns(scaler.columns())


def feature_metadata(parameters: DataFrame, matrix: DataFrame) -> DataFrame:
    """One row: feature names, customer and feature counts, means and scales."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "feature", "mean", "scale")))
    n_customers = matrix.agg(F.count(F.lit(1)).alias("n")).scalar()
    return parameters.agg(ordered.alias("p")).select(
        F.col("p.feature").alias("feature_names"),
        n_customers.alias("n_customers"),
        F.size("p").alias("n_features"),
        F.col("p.mean").alias("scaler_mean"),
        F.col("p.scale").alias("scaler_scale"),
    )


def align_to_model(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly the model's features in the model's order; an absent column and a missing value are 0 before scaling."""
    picked = [
        F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c)
        if c in features.columns
        else F.lit(0.0).alias(c)
        for c in names
    ]
    return features.select("CustomerID", *picked)
