"""Registered queries against their SQL at the smallest scale; ``python -m checks.run`` runs all of them."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.run import connect, differences

SF_DIR = Path("/root/testdata/sf0.001")
SAMPLE = [
    "a2_load_profile",
    "b8_outliers",
    "b18_row_validation",
    "c5_cluster_of_name",
    "d8_scoring_features",
    "d16_characteristics",
    "d17_revenue",
    "e3_rfm_scores",
    "i2_scaled_features",
    "i7_customer_silhouette",
    "i14_density_clusters",
    "i17_score_customers",
    "j1_stream",
]


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    got = entry.queries()[name](spark, str(SF_DIR)).toPandas()
    assert differences(got, connect(SF_DIR).execute(entry.oracle_sql()[name]).df()) == []
