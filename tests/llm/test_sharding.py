import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallybasket.llm import sharding
from tests.llm.conftest import as_table


def placed(docs, **settings):
    return [r.asDict() for r in sharding.shard_by_bytes(docs, **settings).collect()]


def check_whole(out, rows, shards):
    """Every row once, with its size and checksum, slots gapless in every shard."""
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    slots = defaultdict(list)
    for r in out:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def sizes(out, shards):
    found = np.zeros(shards, np.int64)
    for r in out:
        found[r["shard"]] += r["size"]
    return found


def test_awkward_corpus(docs, rows):
    out = placed(docs, shards=5, carry=["text", "lang"])
    check_whole(out, rows, 5)
    total, largest = sum(r["size"] for r in out), max(r["size"] for r in out)
    before = np.cumsum(sizes(out, 5))
    # A boundary misses its place by the tolerance, or by half of the row it falls into.
    assert all(abs(before[j] - total * (j + 1) / 5) <= max(0.001 * total / 5, largest / 2) for j in range(4))
    assert {(r["doc_id"], r["text"]) for r in out} == {(i, t) for i, t, *_ in rows}


def test_slots_follow_the_order_of_keys_and_groups_stay_whole(spark):
    texts = [f"text {i % 400} " + "x" * (i % 37) for i in range(3000)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    out = placed(as_table(spark, rows), shards=4, tolerance=0.02)
    check_whole(out, rows, 4)
    got = sizes(out, 4)
    assert got.max() - got.min() <= 0.04 * got.sum() / 4
    of = defaultdict(set)
    for r in out:
        of[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in of.values())


@pytest.mark.parametrize("text", ["a third of all rows", None, ""])
def test_hot_groups_and_rows_that_repeat_in_full_are_split(spark, text):
    rows = [(7, text, "en", "s")] * 700 + [(i, text, "en", "s") for i in range(500)] + [(10_000 + i, f"{i} rest", "en", "s") for i in range(600)]
    out = placed(as_table(spark, rows), shards=6)
    check_whole(out, rows, 6)
    got = sizes(out, 6)
    assert got.max() - got.min() <= 2 * max(r["size"] for r in out) + 0.002 * got.sum() / 6


def test_parts_have_bounded_rows_and_reruns_agree(spark, monkeypatch):
    rows = [(i, "" if i % 3 else "long " * (i % 90), "en", "s") for i in range(2000)]
    monkeypatch.setattr(sharding, "LEAST_PARTS", 40)
    keys = sharding.saved(sharding.keyed(as_table(spark, rows)), "t")
    splitters = sharding.find_splitters(keys, 4, 0.001)
    rows_before = [0, *(n for _, n, _ in splitters), 2000]
    # A part has at most twice its share of rows and bytes together, plus the tolerance of both of its ends.
    assert len(splitters) == 3 + 39 and max(np.diff(rows_before)) <= 2000 / 40 * 2 * 1.5 + 1
    one, two = placed(as_table(spark, rows), shards=4), placed(as_table(spark, rows).repartition(5), shards=4)
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_fewer_rows_than_shards_one_huge_row_and_none(spark, no_docs):
    few = [(1, "a", "en", "s"), (2, "b" * 90_000, "en", "s"), (None, None, None, None)]
    check_whole(placed(as_table(spark, few), shards=16), few, 16)
    assert placed(no_docs) == []
    one = placed(as_table(spark, few[:1]), shards=3)
    assert len(one) == 1 and one[0]["slot"] == 0
    with pytest.raises(ValueError, match="size"):
        sharding.shard_by_bytes(as_table(spark, few), carry=["size"])


def test_counts_below_probes_are_exact():
    rng = np.random.default_rng(1)
    k1, k2 = rng.integers(-4, 4, 500), rng.integers(-4, 4, 500)
    probes = sorted({(int(a), int(b)) for a, b in rng.integers(-5, 5, (40, 2))})
    p1, p2 = (np.array([p[i] for p in probes]) for i in (0, 1))
    want = [sum(p <= (a, b) for p in probes) for a, b in zip(k1.tolist(), k2.tolist())]
    assert sharding.below(k1, k2, p1, p2).tolist() == want


def test_written_shards_are_read_back_in_order(spark, docs, rows, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((i, t) for i, t, *_ in rows)
