import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybasket import schemas
from tallybasket.operators import features, kmeans, preparation, scoring, segments
from tallybasket.plans import jobs
from tallybasket.sources import artefacts
from tallybasket.streaming import continuous_scoring as stream

AS_OF = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small shop, run through the feature and the training job."""
    rng = np.random.default_rng(3)
    rows = []
    for customer in range(1, 41):
        for _ in range(int(rng.integers(1, 12))):
            when = dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(rng.integers(0, 24 * 50)))
            rows.append(
                (f"i{rng.integers(0, 9)}-{customer}", f"s{rng.integers(0, 5)}", "item", int(rng.integers(1, 9)), when,
                 float(rng.uniform(1, 20 + customer)), float(customer), "UK")
            )
    rows.append(("free", "s1", "item", 1, dt.datetime(2024, 1, 2), 0.0, 99.0, "UK"))
    raw = spark.createDataFrame(rows, schemas.RAW_TRANSACTIONS)
    path = str(tmp_path_factory.mktemp("shop"))
    jobs.feature_job(raw, path)
    trained = jobs.training_job(spark, path, k=3, restarts=3)
    assert trained.clustered.count() == 40  # the customer that spent nothing is gone
    return path


def test_cleaning_report_beside_the_features(spark, folder):
    report = artefacts.load_cleaning_report(spark, folder).first()
    rows = report["audit"]["rows_in"]
    assert report["audit"]["rows_out"] == rows and report["audit"]["retention_pct"] == 100.0
    found = {c["check"]: (c["status"], c["n"], c["message"]) for c in report["checks"]}
    # One row cost nothing.
    assert found["invalid_amounts"] == ("FAIL", 1, "1 invalid amounts") and found["missing_customers"] == ("PASS", 0, "0 missing CustomerIDs")
    assert report["outliers"]["n_rows"] == rows and report["outliers"]["lower_bound"] < report["outliers"]["upper_bound"]


def test_feature_job_reads_the_raw_rows_once(spark, tmp_path, monkeypatch):
    """The raw file is gone after the first table was written; the counts are those of all rows."""
    rows = [(f"i{i}", "s", "d", q, dt.datetime(2024, 1, 1 + i % 9), 2.0, c, "UK") for i, (q, c) in enumerate([(1, 1.0), (2, 2.0), (-1, 1.0), (0, 2.0), (3, None), (4, float("nan")), (5, 3.0)])]
    spark.createDataFrame(rows, schemas.RAW_TRANSACTIONS).coalesce(1).write.parquet(str(tmp_path / "raw"))
    raw, write = spark.read.parquet(str(tmp_path / "raw")), jobs.materialize

    def once(df, name):
        out = write(df, name)
        for file in (tmp_path / "raw").glob("*.parquet"):
            file.unlink()
        return out

    monkeypatch.setattr(jobs, "materialize", once)
    jobs.feature_job(raw, str(tmp_path / "out"))
    audit = artefacts.load_cleaning_report(spark, str(tmp_path / "out")).first()["audit"]
    assert (audit["rows_in"], audit["removed_missing_customer"], audit["removed_cancellations"], audit["removed_no_quantity"], audit["rows_out"]) == (7, 2, 1, 1, 3)
    assert artefacts.load_features(spark, str(tmp_path / "out"))[1].count() == 3


def test_jobs_leave_no_scratch_tables(spark, folder):
    """Training, sweep and report write to their folder; the tables in between are gone."""
    from pathlib import Path

    from tallybasket.session import shared_dir

    scratch = Path(shared_dir(spark)) / "tallybasket"
    before = set(scratch.iterdir()) if scratch.exists() else set()
    trained = jobs.training_job(spark, folder, k=3, restarts=2)
    table, _, best = jobs.find_optimal_clusters(spark, folder, max_clusters=3, restarts=1)
    report = jobs.report_job(spark, folder)
    assert (set(scratch.iterdir()) if scratch.exists() else set()) == before
    # What was returned does not read them.
    assert trained.scores.first()["silhouette"] is not None and trained.clustered.count() == 40
    assert table.count() == 2 and best in (2, 3) and report.count() == 1


def test_feature_metadata(spark, folder):
    row = spark.read.json(f"{folder}/features/metadata").first()
    assert row["n_customers"] == 40 and row["n_features"] == 6 and len(row["scaler_mean"]) == 6
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        artefacts.load_features(spark, f"{folder}/nowhere")


def test_model_metadata_and_information(spark, folder):
    row = artefacts.load_model_metadata(spark, folder).first()
    assert (row["n_clusters"], row["n_features"], row["random_state"]) == (3, 6, 42)
    info = jobs.model_info(spark, folder).first()
    assert info["model_type"] == "KMeans" and info["segment_names"][0] == "VIP Customers"
    assert info["inertia"] == row["inertia"]


def test_clusters_are_numbered_by_spend(spark, folder):
    clustered = artefacts.load_clustered(spark, folder)
    means = [r["m"] for r in clustered.groupBy("Cluster").agg(F.avg("Monetary").alias("m")).orderBy("Cluster").collect()]
    assert means == sorted(means, reverse=True)


def test_loaded_model_repeats_the_training_labels(spark, folder):
    scaled, _, scaler = artefacts.load_features(spark, folder)
    model = artefacts.load_artefacts(spark, folder)
    again = kmeans.assign_clusters(scaled, scaler.names, model.centres).select("CustomerID", F.col("Cluster").alias("again"))
    joined = artefacts.load_clustered(spark, folder).join(again, "CustomerID")
    assert joined.where("Cluster <> again").count() == 0


def scoring_rows(spark, n=30):
    rng = np.random.default_rng(8)
    rows = [
        (int(rng.integers(1, 9)), (dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h))).isoformat(), float(rng.uniform(1, 90)), int(rng.integers(1, 5)))
        for h in rng.integers(0, 1200, n)
    ]
    return spark.createDataFrame(rows, schemas.SCORING_INPUT_TEXT)


def test_scores_by_hand(spark, folder):
    model = artefacts.load_artefacts(spark, folder)
    rows = scoring_rows(spark)
    got = jobs.score_rows(rows, folder, as_of=AS_OF).collect()
    parsed = rows.withColumn("InvoiceDate", F.to_timestamp("InvoiceDate"))
    built = preparation.with_logs(features.scoring_features(parsed, AS_OF)).collect()
    inputs = {r["CustomerID"]: np.array([r[c] for c in model.feature_names], dtype=float) for r in built}
    for row in got:
        z = (inputs[row["CustomerID"]] - model.scaler.means) / model.scaler.scales
        d = np.linalg.norm(np.array(model.centres) - z, axis=1)
        assert row["Segment"] == d.argmin() and np.isclose(row["Distance_to_Center"], d.min())
        plane = (z - model.pca_2d.means) @ np.array(model.pca_2d.loadings).T
        assert np.allclose([row["PCA1_2D"], row["PCA2_2D"]], plane)
        assert np.isclose(row["Feature_Recency"], z[0])


def test_metadata_columns_are_optional(spark, folder):
    full = artefacts.load_artefacts(spark, folder)
    dim, rows = segments.segment_dimension(spark), scoring_rows(spark).withColumn("InvoiceDate", F.to_timestamp("InvoiceDate"))
    assert not [c for c in scoring.score_customers(rows, full, dim, AS_OF, False).columns if c.startswith("PCA")]
    no_plane = scoring.Artefacts(full.centres, full.scaler, None, full.pca_3d)
    assert not [c for c in scoring.score_customers(rows, no_plane, dim, AS_OF).columns if c.startswith("PCA")]
    assert len([c for c in scoring.score_customers(rows, full, dim, AS_OF).columns if c.startswith("PCA")]) == 5


def test_missing_scoring_columns(spark, folder):
    with pytest.raises(ValueError, match="Quantity"):
        jobs.score_rows(scoring_rows(spark).drop("Quantity"), folder)


def test_csv_job(spark, folder, tmp_path):
    scoring_rows(spark, 60).write.option("header", True).csv(str(tmp_path / "in"))
    result = jobs.score_csv_job(spark, str(tmp_path / "in"), folder, str(tmp_path / "out"), AS_OF)
    summary = result.summary.first()
    written = spark.read.option("header", True).csv(result.path)
    assert summary["total_customers"] == written.count() == sum(summary["segment_distribution"].values())
    sample = [r["CustomerID"] for r in result.sample.collect()]
    assert sample == sorted(sample) and len(sample) <= 10
    assert not [c for c in written.columns if c.startswith("PCA")]


def test_segment_info_before_and_after_training(spark, folder, tmp_path):
    assert jobs.segment_info(spark, folder).count() == 3
    assert jobs.segment_info(spark, folder, 7).first()["size"] == 0
    before = jobs.segment_info(spark, str(tmp_path)).collect()
    assert len(before) == 4 and {r["size"] for r in before} == {None}


def test_optimal_clusters_and_report(spark, folder):
    table, elbow_k, best_k = jobs.find_optimal_clusters(spark, folder, max_clusters=4, restarts=1)
    assert table.count() == 3 and elbow_k in (2, 3, 4) and best_k in (2, 3, 4)
    report = jobs.report_job(spark, folder, dt.date(2024, 3, 1)).first()
    assert report["distribution"]["total_customers"] == 40
    summary = artefacts.load_report(spark, f"{folder}/results/executive_summary").first()
    assert summary["project_overview"]["date"] == "2024-03-01" and summary["next_steps"]


def test_stream_equals_batch(spark, folder, tmp_path):
    """Two batches, the second touching some customers again and carrying refused rows."""
    model = artefacts.load_artefacts(spark, folder)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = scoring_rows(spark, 80).orderBy("InvoiceDate").collect()
    bad = [(1, "no date", 5.0, 1), (2, "2024-01-05", -1.0, 1)]
    for part in (rows[:50], [*rows[50:], *bad]):
        spark.createDataFrame(part, schemas.SCORING_INPUT_TEXT).write.mode("append").option("header", True).csv(source)
        stream.start_scoring(stream.read_transactions(spark, source), target, model, AS_OF).awaitTermination()
    expected = jobs.score_rows(spark.createDataFrame(rows, schemas.SCORING_INPUT_TEXT), folder, as_of=AS_OF, include_metadata=False)
    expected = {r["CustomerID"]: (r["Segment"], round(r["Distance_to_Center"], 9)) for r in expected.collect()}
    got = {r["CustomerID"]: (r["Segment"], round(r["Distance_to_Center"], 9)) for r in stream.current_scores(spark, target).collect()}
    assert got == expected
    assert spark.read.parquet(f"{target}/refused").count() == 2


def send(spark, rows, source, target, model, **settings):
    """Append a file of rows to the source and let the stream take it."""
    rows.coalesce(1).write.mode("append").option("header", True).csv(source)
    stream.start_scoring(stream.read_transactions(spark, source), target, model, AS_OF, **settings).awaitTermination()


def test_stream_gives_all_columns_of_a_batch(spark, folder, tmp_path):
    """Three batches with returning customers, with components and features."""
    model, source, target = artefacts.load_artefacts(spark, folder), str(tmp_path / "in"), str(tmp_path / "out")
    rows = scoring_rows(spark, 90).collect()
    for part in range(3):
        send(spark, spark.createDataFrame(rows[part::3], schemas.SCORING_INPUT_TEXT), source, target, model, include_metadata=True)
    want = jobs.score_rows(spark.createDataFrame(rows, schemas.SCORING_INPUT_TEXT), folder, as_of=AS_OF)
    got = stream.current_scores(spark, target)
    assert got.columns == want.columns and [c for c in got.columns if c.startswith("PCA")]
    pairs = zip(sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect())))
    assert all(a == pytest.approx(b) if isinstance(a, float) else a == b for x, y in pairs for a, b in zip(x, y))


def test_a_batch_reads_and_writes_nothing_of_earlier_ones(spark, folder, tmp_path):
    """Later batches touch one customer: only that customer is scored, no folder but those of the batch changes, files do not grow."""
    model, source, target = artefacts.load_artefacts(spark, folder), str(tmp_path / "in"), str(tmp_path / "out")
    rows = scoring_rows(spark, 60)
    send(spark, rows, source, target, model)
    one = rows.select("CustomerID").first()["CustomerID"]
    files = []
    for batch in (1, 2, 3):
        for old in (tmp_path / "out" / "scores").rglob("*.parquet"):
            old.chmod(0)  # would fail if it were read
        send(spark, rows.where(F.col("CustomerID") == one), source, target, model)
        files.append(len(list((tmp_path / "out" / "scores" / f"batch_id={batch}").glob("*.parquet"))))
    for old in (tmp_path / "out" / "scores").rglob("*.parquet"):
        old.chmod(0o644)
    scores = spark.read.parquet(f"{target}/scores")
    assert {r["CustomerID"] for r in scores.where("batch_id > 0").collect()} == {one}
    assert len(set(files)) == 1 and sorted(p.name for p in (tmp_path / "out").iterdir()) == ["checkpoint", "checkpoint-refused", "refused", "scores"]


def test_restart_and_replay_change_nothing(spark, folder, tmp_path):
    """A batch whose commit is lost is run again from the state before it, into the same folder."""
    model, source, target = artefacts.load_artefacts(spark, folder), str(tmp_path / "in"), str(tmp_path / "out")
    rows = scoring_rows(spark, 60)
    for part in (0, 1):
        send(spark, rows.where(F.pmod(F.hash("InvoiceDate"), F.lit(2)) == part), source, target, model)
    before = sorted(map(tuple, stream.current_scores(spark, target).collect()))
    start = lambda: stream.start_scoring(stream.read_transactions(spark, source), target, model, AS_OF).awaitTermination()
    start()
    (tmp_path / "out" / "checkpoint" / "commits" / "1").unlink()
    (tmp_path / "out" / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    start()
    assert sorted(map(tuple, stream.current_scores(spark, target).collect())) == before


def test_missing_values_are_zero_before_scaling(spark):
    from tallybasket.operators.preparation import align_to_model

    rows = spark.createDataFrame([(1, None, 2.0), (2, float("nan"), 3.0)], "CustomerID long, a double, b double")
    assert [tuple(r) for r in align_to_model(rows, ["a", "b", "c"]).collect()] == [(1, 0.0, 2.0, 0.0), (2, 0.0, 3.0, 0.0)]


def test_more_clusters_than_distinct_points(spark):
    points = spark.createDataFrame([(i, float(i % 2), 0.0, float(i)) for i in range(8)], "CustomerID long, a double, b double, Monetary double")
    fit = kmeans.fit_kmeans(points, ["a", "b"], 4, restarts=1)
    labelled = kmeans.assign_clusters(points, ["a", "b"], fit.centres)
    order = kmeans.spend_order(labelled, fit.k)
    assert fit.k < 4 and len(kmeans.ordered_centres(fit.fitted, order)) == fit.k
