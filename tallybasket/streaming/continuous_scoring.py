"""Scores that follow a stream of transactions.

A streaming aggregation holds one row of sums, extremes and days for every customer in Spark's state store. Each
micro-batch adds the rows that arrived to the customers it touches, and update mode hands on these customers alone, with all
they ever bought; they are scored and written to a folder named after the batch. A batch reads no earlier files, whatever the
age of the stream. On replay the state is that before the batch and the folder is replaced, so a restart repeats nothing.

No watermark: the features need the complete history, so no customer's state expires. Days are kept as a set, since distinct days
are a feature; there are at most as many as days in the calendar. Refused rows go to a second query on the same source.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybasket.functions import columns as fx
from tallybasket.operators import preparation, scoring
from tallybasket.operators.cleaning import split_scoring_rows
from tallybasket.operators.segments import segment_dimension
from tallybasket.schemas import SCORING_INPUT_TEXT


def read_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of CSV files with (CustomerID, InvoiceDate text, Amount, Quantity)."""
    return spark.readStream.schema(SCORING_INPUT_TEXT).option("header", True).csv(folder)


def customer_state(valid: DataFrame) -> DataFrame:
    """One row per customer of what the features need; every column can be added to by later rows."""
    amount, ts = F.col("Amount"), F.col("InvoiceDate")
    return valid.groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(amount).alias("amount"),
        F.count(amount).alias("n_amount"),
        F.sum("Quantity").alias("quantity"),
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
        F.collect_set(F.to_date(ts)).alias("days"),
    )


def features_from_state(state: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """The scoring features of every customer in ``state``."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return state.select(
        "CustomerID",
        fx.whole_days(as_of, F.col("last")).alias("Recency"),
        F.col("n").alias("Frequency"),
        F.coalesce("amount", F.lit(0)).alias("Monetary"),
        F.try_divide("amount", F.col("n_amount").cast("double")).alias("AvgTransactionValue"),
        F.col("n").alias("TotalTransactions"),
        F.col("quantity").alias("TotalQuantity"),
        (fx.whole_days(F.col("last"), F.col("first")) + 1).alias("CustomerLifetime"),
        fx.ratio(F.col("n"), F.size("days")).alias("PurchaseFrequency"),
    )


def score_state(
    state: DataFrame, model: scoring.Artefacts, as_of: dt.datetime | Column, include_metadata: bool = False
) -> DataFrame:
    """Scores as in batch: PCA columns only with ``include_metadata``."""
    names = model.feature_names
    built = preparation.with_logs(features_from_state(state, as_of), only=names)
    inputs = preparation.scale_features(preparation.align_to_model(built, names), model.scaler)
    return scoring.score_inputs(inputs, model, segment_dimension(state.sparkSession), include_metadata)


def _scores_writer(folder: str, model: scoring.Artefacts, as_of: dt.datetime | None, include_metadata: bool):
    def write(touched: DataFrame, batch_id: int) -> None:
        until = F.lit(as_of) if as_of is not None else F.current_timestamp()
        scored = score_state(touched, model, until, include_metadata)
        scored.write.mode("overwrite").parquet(f"{folder}/scores/batch_id={batch_id}")

    return write


def _refused_writer(folder: str):
    def write(refused: DataFrame, batch_id: int) -> None:
        refused.write.mode("overwrite").parquet(f"{folder}/refused/batch_id={batch_id}")

    return write


@dataclass(frozen=True)
class Scoring:
    """The two running queries."""

    scores: StreamingQuery
    refused: StreamingQuery

    def awaitTermination(self) -> None:
        self.scores.awaitTermination()
        self.refused.awaitTermination()

    def stop(self) -> None:
        self.scores.stop()
        self.refused.stop()


def start_scoring(
    stream: DataFrame,
    folder: str,
    model: scoring.Artefacts,
    as_of: dt.datetime | None = None,
    include_metadata: bool = False,
    **trigger,
) -> Scoring:
    """Start the queries; ``trigger`` is passed on, by default ``availableNow=True``.

    The number of state partitions is ``spark.sql.shuffle.partitions`` at the first start and stays with the folder.
    """
    valid, refused = split_scoring_rows(stream)
    trigger = trigger or {"availableNow": True}
    scores = customer_state(valid).writeStream.outputMode("update").foreachBatch(_scores_writer(folder, model, as_of, include_metadata))
    others = refused.writeStream.foreachBatch(_refused_writer(folder))
    return Scoring(
        scores.option("checkpointLocation", f"{folder}/checkpoint").trigger(**trigger).start(),
        others.option("checkpointLocation", f"{folder}/checkpoint-refused").trigger(**trigger).start(),
    )


def current_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The latest score of every customer."""
    scores = spark.read.parquet(f"{folder}/scores")
    kept = [c for c in scores.columns if c not in ("CustomerID", "batch_id")]
    latest = F.max_by(F.struct(*kept), "batch_id")
    return scores.groupBy("CustomerID").agg(latest.alias("s")).select("CustomerID", "s.*")
