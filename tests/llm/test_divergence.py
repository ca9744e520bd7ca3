import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallybasket.llm import divergence
from tallybasket.llm.common import bytes_of
from tests.llm.conftest import as_table

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, min_docs, top):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        count[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        everything = sum((count[lang, s] for s in sources), Counter())

        def shares(of):
            n = sum(of[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (of[t] + 2) // n for t in kept}

        p, q = {s: shares(count[lang, s]) for s in sources}, shares(everything)
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(sorted(found)[:limit], 1)]
    return sorted(out)


def run(docs, **settings):
    names = ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r[c] for c in names) for r in divergence.source_divergence(docs, **settings).collect())


@pytest.mark.parametrize("min_docs", [1, 3, 10])
def test_against_brute_force(docs, rows, min_docs):
    assert run(docs, min_docs=min_docs) == brute(rows, min_docs, 10)


def test_sources_without_terms_and_ties(spark):
    rows = [(i, "b a", "en", s) for i, s in enumerate("xxyy")] + [(9, "123 _ \x00", "en", "z"), (10, None, "de", "x"), (11, None, "de", None), (12, "c", None, "x")]
    got = run(as_table(spark, rows), min_docs=2)
    assert got == brute(rows, 2, 10)
    assert ("de", "", "pair", "x", 0, 1) in got and [r for r in got if r[1] == "z" and r[2] == "pair"]


def test_terms_of_every_length(spark):
    words = ["a" * n for n in range(1, 40)] + ["é" * n for n in range(1, 30)] + ["ab" * 400, "zZz", "Zzz", "日本語"]
    rows = [(i, " ".join(words[i % 7 :: 2] * 3), "en", f"s{i % 3}") for i in range(12)] + [(50, "x" * 300_000 + " a", "en", "s1")]
    assert run(as_table(spark, rows), min_docs=1, top=None) == brute(rows, 1, None)


def test_every_bucket_is_in_order_of_bytes():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abé"), rng.integers(1, 14))) for _ in range(3000)]
    import pyarrow as pa

    data, offsets = bytes_of(pa.array(words))
    seen = []
    for order, begins in divergence.buckets(data, offsets[:-1], offsets[1:]):
        got = [words[i] for i in order]
        assert got == sorted(got, key=str.encode)
        assert begins.tolist() == [True] + [a != b for a, b in zip(got[1:], got)]
        same = order[1:][~begins[1:]] > order[:-1][~begins[1:]]
        assert same.all()  # equal terms keep their order
        seen += order.tolist()
    assert sorted(seen) == list(range(3000))


def test_shares_beyond_64_bits():
    counts = np.array([0, 5, 9_000_000_001, 10**14])
    of = 10**14 + 2 * 10**7
    assert divergence.share(counts, of).tolist() == [1 + 10**9 * (c + 2) // of for c in counts.tolist()]
    assert divergence.share(counts, 1 << 64).tolist() == [1 + 10**9 * (c + 2) // (1 << 64) for c in counts.tolist()]


def test_blocks_of_terms_do_not_matter(docs, rows, no_docs, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 7)
    assert run(docs, min_docs=2) == brute(rows, 2, 10)
    assert run(no_docs) == []
