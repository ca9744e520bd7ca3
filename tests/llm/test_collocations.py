import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallybasket.llm import collocations
from tests.llm.conftest import as_table

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, min_count, max_words, top):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = defaultdict(int)
        for p, a in found.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        scored = []
        for p, a in found.items():
            if inside[p] >= a:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def run(docs, **settings):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in names) for r in collocations.collocations(docs, **settings).collect())


@pytest.mark.parametrize("bits", [64, 6])
def test_against_brute_force(docs, rows, bits):
    """With six bits all fingerprints collide, and counts stay exact."""
    want = brute(rows, 3, 5, 50)
    assert len(want) > 40 and run(docs, min_count=3, top=50, bits=bits, filter_bits=1 << 12) == want


def test_overlaps_pieces_ties_and_covered_phrases(spark):
    texts = ["a a a a", "New York, new york! NEW  YORK\tnew york", "x y z. x y z; x y z", "x y", "é É é É", "日本 語。日本 語", "a\x00b c\na\x00b c"]
    rows = [(i, t, lang, None) for i, t in enumerate(texts) for lang in ("en", None, "und", "")] + [(9, None, "en", None), (10, "", "de", None)]
    for least in (1, 2, 3):
        assert run(as_table(spark, rows), min_count=least, top=None) == brute(rows, least, 5, 10**6)


def test_longest_phrase_and_percentage(spark):
    rows = [(i, "a b c d", "en", None) for i in range(9)] + [(20, "a b", "en", None)]
    assert {r[2] for r in run(as_table(spark, rows), min_count=2, max_words=4)} == {"a b", "a b c d"}
    assert {r[2] for r in run(as_table(spark, rows), min_count=2, max_words=4, covered_percent=90)} == {"a b c d"}
    assert {r[2] for r in run(as_table(spark, rows), min_count=2, max_words=2)} == {"a b", "b c", "c d"}


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(collocations, "STEP_BYTES", 200)
    rng = np.random.default_rng(0)
    words = [" ".join(rng.choice(list("abcdef"), rng.integers(1, 40))) for _ in range(400)]
    rows = [(1, ". ".join(words), "en", None), (2, "a b " * 3000, "de", None)]
    columns = collocations._cut(pa.array([r[1] for r in rows]), pa.array(["en", "de"]))
    assert max(len(data) for data, *_ in columns) == 12_000
    assert run(as_table(spark, rows), min_count=5, top=100) == brute(rows, 5, 5, 100)


def test_counts_beyond_64_bits_and_empty_tables(spark, docs, no_docs):
    assert run(no_docs) == [] and run(docs, min_count=10**6) == []
    counted = spark.createDataFrame([("en", 1, "a", 9 * 10**11), ("en", 1, "b", 8 * 10**11), ("en", 2, "a b", 7 * 10**11)], "lang string, n int, phrase string, a long")
    totals = spark.createDataFrame([("en", 3 * 10**14)], "lang string, total long")
    real = collocations.frequent_phrases
    try:
        collocations.frequent_phrases = lambda *a, **k: (counted, totals)
        got = run(docs)
    finally:
        collocations.frequent_phrases = real
    assert got == [("en", 1, "a b", 7 * 10**11, 9 * 10**11, 8 * 10**11, 3 * 10**14, 1000 * 7 * 10**11 * 3 * 10**14 // (72 * 10**22))]
