import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from tallybasket import schemas
from tallybasket.operators import cleaning
from tallybasket.sources import transactions

NAN = float("nan")


def day(n, hour=0):
    return dt.datetime(2022, 3, n, hour)


@pytest.fixture(scope="module")
def raw(spark):
    """Each way a row can be wrong, alone and together; a free item, a price that is no number, a year's turn."""
    at = dt.datetime
    rows = [
        ("N-901", "tea-01", "green tea", 6, at(2021, 11, 30, 9, 15), 3.25, 71.0, "PT"),
        ("N-901", "cup-07", "blue cup", 2, at(2021, 11, 30, 9, 15), 8.5, 71.0, "PT"),
        ("N-902", "tea-01", "green tea", -6, at(2021, 12, 1, 18, 40), 3.25, 71.0, "PT"),
        ("N-903", "jar-03", "honey jar", 1, at(2021, 12, 4, 11, 5), 12.75, NAN, "PT"),
        ("N-904", "cup-07", "blue cup", -1, at(2021, 12, 4, 11, 20), 8.5, NAN, "NO"),
        ("N-905", "mat-11", "straw mat", 0, at(2021, 12, 31, 23, 59), 19.9, 88.0, "NO"),
        ("N-906", "mat-11", "straw mat", 4, at(2022, 1, 1, 0, 0), 19.9, 88.0, "NO"),
        ("N-907", "pen-02", "ink pen", 15, at(2022, 1, 2, 7, 30), 0.0, 93.0, "NO"),
        ("N-908", "pen-02", "ink pen", 3, at(2022, 2, 14, 16, 45), NAN, 93.0, "PT"),
        ("N-909", "jar-03", "honey jar", 2, at(2022, 2, 28, 12, 0), 12.755, 105.0, "CL"),
        ("N-910", "tea-01", "green tea", 9, at(2022, 3, 1, 8, 0), 3.1, 105.0, "CL"),
    ]
    return spark.createDataFrame(rows, schemas.RAW_TRANSACTIONS)


def test_unknown_cancelled_and_empty_rows_go(raw):
    clean = cleaning.clean_transactions(raw)
    assert sorted(r["InvoiceNo"] for r in clean.collect()) == ["N-901", "N-901", "N-906", "N-907", "N-908", "N-909", "N-910"]
    assert clean.schema["CustomerID"].dataType.simpleString() == "bigint"


def test_amount_and_date_parts(raw):
    clean = {r["InvoiceNo"]: r for r in cleaning.clean_transactions(raw).collect()}
    turn = clean["N-906"]
    assert turn["Amount"] == pytest.approx(79.6) and clean["N-909"]["Amount"] == pytest.approx(25.51)
    assert (turn["YearMonth"], turn["DayOfWeek"], turn["Hour"]) == ("2022-01", "Saturday", 0)
    assert clean["N-907"]["Amount"] == 0.0


def test_clean_rows_have_the_declared_columns(raw):
    assert set(cleaning.clean_transactions(raw).columns) == set(schemas.CLEAN_TRANSACTIONS.names)


def test_audit_counts_each_step(raw):
    """A row that is unknown and cancelled counts where it is removed first."""
    row = cleaning.cleaning_audit(raw).first()
    assert (row["rows_in"], row["removed_missing_customer"], row["removed_cancellations"], row["rows_out"]) == (11, 2, 1, 7)
    assert row["removed_no_quantity"] == 1 and row["removed_total"] == 4
    assert row["retention_pct"] == pytest.approx(100 * 7 / 11, abs=0.01)


def test_zero_quantity_goes_without_counting_as_cancellation(spark):
    rows = [("a", "s", "d", 0, day(1), 1.0, 1.0, "UK"), ("b", "s", "d", 2, day(1), None, 1.0, "UK")]
    raw = spark.createDataFrame(rows, schemas.RAW_TRANSACTIONS)
    row = cleaning.cleaning_audit(raw).first()
    assert (row["removed_cancellations"], row["removed_no_quantity"], row["rows_out"]) == (0, 1, 1)
    assert cleaning.clean_transactions(raw).first()["Amount"] is None


def test_quality_checks_good_and_bad(spark):
    schema = "CustomerID double, Quantity int, InvoiceDate timestamp, Amount double"
    good = spark.createDataFrame([(1.0, 1, day(1), 5.0), (2.0, 2, day(2), 6.0)], schema)
    assert {r["status"] for r in cleaning.quality_checks(good).collect()} == {"PASS"}
    bad = spark.createDataFrame(
        [
            (7.0, -4, day(9), 9.5),
            (None, 3, day(9), -0.5),
            (None, 2, None, 12.0),
            (None, 1, day(10), 4.0),
            (8.0, 2, None, 0.0),
            (9.0, 1, None, -3.0),
            (5.0, 6, None, 1.0),
        ],
        schema,
    )
    got = {r["check"]: (r["status"], r["n"], r["message"]) for r in cleaning.quality_checks(bad).collect()}
    assert got == {
        "missing_customers": ("FAIL", 3, "3 missing CustomerIDs"),
        "negative_quantities": ("FAIL", 1, "1 non-positive quantities"),
        "invalid_dates": ("FAIL", 4, "4 invalid dates"),
        "invalid_amounts": ("FAIL", 3, "3 invalid amounts"),
    }


def test_fences_and_outliers(spark):
    clean = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 10, 100)], "Amount double")
    row = cleaning.outlier_report(clean).first()
    assert (row["q1"], row["q3"], row["lower_bound"], row["upper_bound"]) == (2.0, 10.0, -10.0, 22.0)
    assert row["n_outliers"] == 1
    assert [r["Amount"] for r in cleaning.flag_outliers(clean).where("IsOutlier").collect()] == [100.0]


def test_summary_of_amount(spark):
    clean = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "Amount double")
    row = cleaning.amount_summary(clean).first()
    assert (row["count"], row["mean"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]) == (
        4, 4.0, 1.0, 1.75, 2.5, 4.75, 10.0,
    )


def test_row_validation(spark):
    rows = [
        (1, "2023-12-01T10:30:00", 5.0, 1),
        (2, "not a date", 5.0, 1),
        (3, "2023-12-01", 1_000_001.0, 1),
        (4, "2023-12-01", 1_000_000.0, 1),
        (5, "2023-12-01", 0.0, 0),
    ]
    df = spark.createDataFrame(rows, schemas.SCORING_INPUT_TEXT)
    valid, refused = cleaning.split_scoring_rows(df)
    assert sorted(r["CustomerID"] for r in valid.collect()) == [1, 4]
    assert {r["CustomerID"]: r["reasons"] for r in refused.collect()} == {
        2: ["date_not_parsable"],
        3: ["amount_too_high"],
        5: ["amount_not_positive", "quantity_not_positive"],
    }


def test_csv_round_trip(raw, tmp_path, spark):
    clean = cleaning.clean_transactions(raw)
    path = transactions.write_clean_csv(clean, str(tmp_path / "clean"))
    back = transactions.read_processed_csv(spark, path)
    assert back.schema["InvoiceDate"].dataType.simpleString() == "timestamp"
    assert sorted(map(repr, back.select(*clean.columns).collect())) == sorted(map(repr, clean.collect()))


def test_raw_csv_and_missing_file(raw, tmp_path, spark):
    raw.where("CustomerID = CustomerID").write.option("header", True).csv(str(tmp_path / "raw"))
    assert transactions.read_raw_csv(spark, str(tmp_path / "raw")).count() == 11
    with pytest.raises(AnalysisException):
        transactions.read_raw_csv(spark, str(tmp_path / "absent"))


def test_month_folders(raw, tmp_path, spark):
    path = transactions.write_clean_table(cleaning.clean_transactions(raw), str(tmp_path / "months"))
    back = transactions.read_parquet_table(spark, path)
    months = {r["YearMonth"]: r["count"] for r in back.groupBy("YearMonth").count().collect()}
    assert months == {"2021-11": 2, "2022-01": 2, "2022-02": 2, "2022-03": 1}


def test_profile_counts_columns(raw):
    row = transactions.load_profile(raw).first()
    assert (row["n_rows"], row["n_columns"], row["n_products"]) == (11, 8, 5)


def test_missing_columns_are_named(spark, tmp_path):
    with pytest.raises(ValueError, match="Amount"):
        schemas.require_columns(spark.createDataFrame([(1,)], "CustomerID long"), schemas.SCORING_COLUMNS)
    spark.createDataFrame([(1,)], "CustomerID long").write.option("header", True).csv(str(tmp_path / "few"))
    with pytest.raises(ValueError, match="InvoiceDate"):
        transactions.read_scoring_csv(spark, str(tmp_path / "few"))


def test_empty_batch_file_is_an_error(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("CustomerID,InvoiceDate,Amount,Quantity\n")
    with pytest.raises(ValueError, match="no rows"):
        transactions.read_scoring_csv(spark, str(tmp_path / "empty.csv"))
