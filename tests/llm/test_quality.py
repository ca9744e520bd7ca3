"""Classifier and rules: statistics against brute force, held-out accuracy, exact binomial tails."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybasket.llm import quality_model, quality_rules, statistics
from tallybasket.llm.common import table

SF = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    words = WORD.findall(text)
    grams = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": repeated,
        "n_repeat_words": len(covered),
        "n_distinct_words": len(set(words)),
    }


def test_statistics_against_brute_force(rows):
    rng = random.Random(9)
    texts = [t or "" for _, t, _, _ in rows] + ["".join(rng.choice("ab \n#é|") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    got = statistics.statistics_of(pa.array(texts))
    for i, text in enumerate(texts):
        for name, value in counted(text).items():
            assert got[name][i] == value, (name, text[:80])


def test_rules_on_awkward_rows(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(25)] + [(0, 1), (None, 1), (9999, 0), (3, None)], "doc_id long, quality int")
    out = quality_rules.apply_rules(docs, labels).collect()
    want = []
    for doc_id, text, _, _ in rows:
        c = counted(text or "")
        base = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        want.append((str(doc_id), *(c[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), base, not base))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    # So few labels certify no cutoff: what the base rules keep stays.
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in out) == sorted(want)
    assert quality_rules.apply_rules(no_docs, labels).count() == 0
    assert quality_rules.apply_rules(docs, labels.limit(0)).count() == len(rows)


def test_binomial_tail_is_exact():
    for n in (1, 7, 60, 400):
        for p in (0.01, 0.03, 0.5, 0.9):
            exact = 0.0
            for k in range(n + 1):
                exact += math.comb(n, k) * p**k * (1 - p) ** (n - k)
                assert quality_rules.binomial_tail(k, n, p) == pytest.approx(min(exact, 1.0), rel=1e-9, abs=1e-13)


def test_rules_reject_junk_and_keep_good_documents(spark):
    out = quality_rules.apply_rules(table(spark, SF, "documents"), table(spark, SF, "labels"))
    seen = out.where(~F.col("base_failed")).join(table(spark, SF, "labels"), "doc_id")
    shares = {r["quality"]: r["kept"] for r in seen.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert shares[0] < 0.02 and shares[1] > 0.98


def test_no_cutoff_is_certified_beyond_the_bound(spark):
    """Good documents that look like junk in a tenth of cases: no level may reject them all."""
    rng = np.random.default_rng(0)
    v = [[float(rng.random() < 0.1)] + [0.0] * (len(quality_rules.rules()) - 1) for _ in range(2000)]
    good = spark.createDataFrame([("en", i, x) for i, x in enumerate(v)], "stratum string, doc_id long, v array<double>")
    cutoffs = quality_rules.choose_cutoffs(good).collect()
    assert all(r["cutoffs"][0] >= 1.0 for r in cutoffs)


def test_held_out_accuracy(spark):
    scored = quality_model.quality_scores(table(spark, SF, "documents"), table(spark, SF, "labels"))
    rows = scored.join(table(spark, SF, "labels"), "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    assert len(rows) > 1000 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97
    # Calibration: the mean score is near the share of good documents.
    assert abs(np.mean([r["score"] for r in rows]) - np.mean([r["quality"] for r in rows])) < 0.03
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_held_out_labels_are_never_learned(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    flipped = labels.withColumn("quality", F.when(quality_model.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["score"] for r in quality_model.quality_scores(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in quality_model.quality_scores(docs, flipped).collect()}
    assert max(abs(a[i] - b[i]) for i in a) < 1e-9


def test_classifier_on_awkward_rows(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(25)] + [(0, 1), (None, 1), (9999, 0), (3, None)], "doc_id long, quality int")
    out = quality_model.quality_scores(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    empty = {r["score"] for r in out if r["doc_id"] in (400, 401)}
    assert len(empty) == 1
    assert {r["score"] for r in quality_model.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.quality_scores(no_docs, labels).count() == 0


def test_isotonic_pools_violators():
    got = quality_model.isotonic(np.array([1, 1, 2, 1]), np.array([0.0, 1.0, 1.0, 1.0]))
    assert got.tolist() == pytest.approx([0, 2 / 3, 2 / 3, 1])


def test_copies_are_one_observation(spark):
    """Two hundred good texts certify a cutoff; one of them, labelled two hundred times, is one document and certifies none."""
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(80))
    values = [(f"v{i}", [float(rng.random()) for _ in quality_rules.rules()]) for i in range(600)]
    schema = "stratum string, text_hash long, v array<double>"
    many = spark.createDataFrame([("en", hash(name), v) for name, v in values], schema)
    copies = spark.createDataFrame([("en", 1, values[0][1])] * 600, schema)
    assert quality_rules.choose_cutoffs(many).count() == 1 and quality_rules.choose_cutoffs(copies).count() == 0
    # The same through the operator: labels of copies add nothing.
    one, ids = text(), range(300)
    docs = spark.createDataFrame([(i, one, "en") for i in ids], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")
    assert {r["level"] for r in quality_rules.apply_rules(docs, labels).collect()} == {None}
