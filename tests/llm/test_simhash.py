import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallybasket.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, distance):
    """Least position reachable for each distinct fingerprint."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= distance and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_groups_against_brute_force(docs, rows):
    ids = [r[0] for r in rows]
    fps = [fingerprint(r[1]) for r in rows]
    label = classes(fps, 2)
    least = {k: min([i for i, x in zip(ids, label) if x == k and i is not None], default=None) for k in set(label)}
    want = sorted((str(i), f"{fp:016x}", str(least[k])) for i, fp, k in zip(ids, fps, label))
    out = simhash.simhash_groups(docs).select("doc_id", simhash.as_hex().alias("h"), "component_id").collect()
    assert sorted((str(r["doc_id"]), r["h"], str(r["component_id"])) for r in out) == want


def test_every_pair_within_two_bits_is_found(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(6):
            fps.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False)))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    for distance in (0, 1, 2):
        got = {(r["u"], r["v"]) for r in simhash.anchor_links(spark.createDataFrame([(x,) for x in signed], "fp long"), distance).collect()}
        want = {(max(a, b), min(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
        assert got == want and (want or not distance)


def test_anchors_are_a_perfect_code():
    flips = simhash._flips()
    assert [len(f) for f in flips] == [1] + [16] * 31
    assert all(len(set(f)) == len(f) and max(x.bit_count() for x in f) <= 2 for f in flips)


def test_no_rows_and_carried_columns(docs, no_docs):
    assert simhash.simhash_groups(no_docs).count() == 0
    out = simhash.simhash_groups(docs, carry=["source"])
    assert out.where(F.col("source") == "s9").count() == 1
