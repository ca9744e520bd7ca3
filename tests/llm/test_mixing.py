import pytest
from pyspark.sql import functions as F

from tallybasket.llm import mixing
from tests.llm.conftest import as_table


def fill(sizes, weights, total, cap):
    """Water-filling by hand: clamp, share the rest, repeat."""
    clamped = set()
    while True:
        rest = total - sum(cap * sizes[k] for k in clamped)
        open_weight = sum(w for k, w in weights.items() if k not in clamped)
        over = {k for k, w in weights.items() if k not in clamped and open_weight and w * rest / open_weight > cap * sizes[k]}
        if not over:
            return {k: cap * sizes[k] if k in clamped else w * rest / open_weight if open_weight else 0.0 for k, w in weights.items()}
        clamped |= over


def test_targets_and_taken(docs, rows):
    out = mixing.mix(docs, mixing.cycling_weights(docs)).collect()
    assert len(out) == len(rows)
    words = lambda t: len((t or "").translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).replace("\x1c", "x").split(" ")) - (
        (t or "").translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ").count("")
    )
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    names = sorted([s for s in sizes if s is not None]) + [None]
    weights = {s: float([5, 2, 1][i % 3]) for i, s in enumerate(names)}
    want = fill(sizes, weights, 1.5 * sum(sizes.values()), 2.0)
    taken = {}
    for r in out:
        source = None if r["source_key"] == mixing.NO_SOURCE else r["source_key"]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["repeats"] * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
    largest = max(r["size"] for r in out)
    assert all(abs(taken[s] - want[s]) <= largest for s in taken)
    again = mixing.mix(docs.repartition(7), mixing.cycling_weights(docs)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_many_documents_come_near_their_target(spark):
    table = as_table(spark, [(i, "w " * (1 + i % 37), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(3000)])
    out = mixing.mix(table, mixing.cycling_weights(table))
    per = out.groupBy("source_key").agg(F.sum("taken").alias("t"), F.max("target").alias("w")).collect()
    assert all(abs(r["t"] - r["w"]) <= 40 for r in per)


def test_weights_that_are_missing_or_too_small(spark):
    table = as_table(spark, [(1, "a b c d", "en", "x"), (2, "a b", "en", "y"), (3, "a", "en", None)])
    weights = spark.createDataFrame([("x", 1.0), (None, 0.0)], "source string, weight double")
    out = {r["doc_id"]: (r["target"], r["taken"]) for r in mixing.mix(table, weights, total_share=5.0).collect()}
    assert out == {1: (8.0, 8), 2: (0.0, 0), 3: (0.0, 0)}


def test_no_rows(no_docs):
    assert mixing.mix(no_docs, mixing.cycling_weights(no_docs)).count() == 0


def test_native_plan(docs):
    plan = mixing.mix(docs, mixing.cycling_weights(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("carry", [[], ["text"]])
def test_a_hot_id_does_not_miss_the_target(spark, carry):
    """One row makes a third of a source that takes one and a half of itself: its copies are taken one by one."""
    rows = [(7, "w " * 10, "en", "a")] * 1500 + [(i + 100, "w " * 10, "en", "a") for i in range(3000)]
    docs = as_table(spark, rows)
    weights = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    out = mixing.mix(docs, weights, total_share=1.5, carry=carry)
    taken = out.agg(F.sum("taken")).first()[0]
    assert abs(taken - 67_500) < (200 if not carry else 1500)
    assert out.where("doc_id = 7").select("repeats").distinct().count() == 2


def test_sources_are_numbered_over_partitions(spark):
    names = [f"s{i:03}" for i in range(40)] + [None]
    docs = as_table(spark, [(i, "w", "en", s) for i, s in enumerate(names * 2)])
    got = {r["source"]: r["weight"] for r in mixing.cycling_weights(docs).collect()}
    assert got == {s: [5, 2, 1][i % 3] for i, s in enumerate(names)}


def test_clashing_carried_columns_are_refused(docs):
    with pytest.raises(ValueError, match="size"):
        mixing.mix(docs, mixing.cycling_weights(docs), carry=["size"])
