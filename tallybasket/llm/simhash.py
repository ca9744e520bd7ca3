"""SimHash near-duplicates by anchor points of a covering code.

**Fingerprint.** A-Z are lower-cased, words joined by one space, and every run of ``shingle_words``
words, repeats included (a shorter text: all its words), is hashed by XXH64 with seed 42. A bit of the
fingerprint is set if it is set in more than half of the hashes; a text without words has fingerprint 0.

**Links.** Two fingerprints at distance 2 or less differ in at most one bit of one of two 31-bit halves
(bits 0-30 and 31-61; the two topmost bits are compared with the rest). The Hamming code of length 31 is
perfect: its code words are the anchors, every half is within radius 1 of exactly one of them. Each
fingerprint stands as *home* at that anchor and as *guest* at all anchors within radius + 1 = 2 (16 of
them, or 1 for a code word). If two halves differ in one bit, the second is a guest where the first is at
home, so one equality join on the anchor meets every pair; the whole fingerprints are compared there.

Copies share a fingerprint and are merged first; no group is ever expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybasket.llm.common import bytes_of, prepare_tasks, saved, single, steps, text_or_empty, words_of
from tallybasket.operators.components import connected_components

SEED = 42
HALF_BITS = 31
#: The anchors below serve two halves with one differing bit each at most in one of them.
MAX_DISTANCE = 2
#: Hashes whose bits are counted in one step.
COUNT_STEP = 1 << 16

_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNT_STEP):
        part = np.ascontiguousarray(hashes[at : at + COUNT_STEP]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints_of(texts: pa.Array, shingle_words: int) -> np.ndarray:
    """Unsigned 64-bit fingerprints of texts without nulls."""
    out = np.zeros(len(texts), np.uint64)
    hash_of = xxhash.xxh64_intdigest
    for start, stop in steps(texts):
        data, offsets = bytes_of(texts[start:stop])
        data = _UPPER[data]
        starts, ends, first = words_of(data, offsets)
        if not len(starts):
            continue
        lengths = ends - starts
        # Words of all texts of the step, each followed by one space.
        at = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths + 1, out=at[1:])
        joined = np.full(at[-1], 32, np.uint8)
        joined[np.arange(at[-1] - len(starts)) + np.repeat(np.arange(len(starts)), lengths)] = data[
            np.arange(at[-1] - len(starts)) + np.repeat(starts - (at[:-1] - np.arange(len(starts))), lengths)
        ]
        line = joined.tobytes()
        for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            if a == b:
                continue
            width = min(shingle_words, b - a)
            begin = at[a : b - width + 1].tolist()
            end = (at[a + width : b + 1] - 1).tolist()
            hashes = np.fromiter((hash_of(line[i:j], SEED) for i, j in zip(begin, end)), np.uint64, len(begin))
            out[start + row] = _majority(hashes)
    return out


def fingerprints(docs: DataFrame, shingle_words: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id`` (long, may be null), the columns in ``carry`` and ``fp`` (long: the fingerprint's bits) of every row."""
    prepare_tasks(docs.sparkSession)
    names = ["doc_id", *carry, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = single(batch.column("text"))
            fp = fingerprints_of(texts, shingle_words).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(fp)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, text_or_empty().alias("text"))
    kept = [f for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("fp", T.LongType())]))


def _syndrome(half: Column) -> Column:
    """Position (1 to 31) of the bit that separates the half from its anchor, 0 for a code word."""
    bits = []
    for j in range(5):
        mask = sum(1 << (p - 1) for p in range(1, HALF_BITS + 1) if p >> j & 1)
        bits.append(F.bit_count(half.bitwiseAND(F.lit(mask))) % 2 * F.lit(1 << j))
    return sum(bits[1:], bits[0])


def _flips() -> list[list[int]]:
    """For each syndrome the bit flips that lead to the anchors within distance 2, the nearest first."""
    out = [[0]]
    for s in range(1, HALF_BITS + 1):
        pairs = [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, HALF_BITS + 1) if i < i ^ s]
        out.append([1 << (s - 1), *pairs])
    return out


def _halves(fps: DataFrame) -> DataFrame:
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF_BITS) - 1))
    high = F.shiftrightunsigned("fp", HALF_BITS).bitwiseAND(F.lit((1 << HALF_BITS) - 1))
    parts = F.array(
        F.struct(F.lit(0).alias("side"), low.alias("half")), F.struct(F.lit(1).alias("side"), high.alias("half"))
    )
    return fps.select("fp", F.explode(parts).alias("p")).select(
        "fp", "p.side", "p.half", _syndrome(F.col("p.half")).cast("int").alias("syndrome")
    )


def anchor_links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """All pairs ``u`` > ``v`` of distinct fingerprints at most ``max_distance`` bits apart; ``fps`` has them in ``fp``."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"max_distance is 0 to {MAX_DISTANCE}")
    halves = _halves(fps)
    table = F.array(*[F.array(*[F.lit(x).cast("long") for x in row]) for row in _flips()])
    flips = F.element_at(table, F.col("syndrome") + 1)
    anchor = lambda flip: F.col("half").bitwiseXOR(flip).bitwiseOR(F.shiftleft(F.col("side").cast("long"), 40))
    home = halves.select(F.col("fp").alias("u"), anchor(flips[0]).alias("anchor"))
    guest = halves.select(F.col("fp").alias("v"), F.explode(F.transform(flips, anchor)).alias("anchor"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance
    met = home.join(guest, "anchor").where((F.col("u") != F.col("v")) & near)
    return met.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def simhash_groups(
    docs: DataFrame, shingle_words: int = 3, max_distance: int = MAX_DISTANCE, carry: Sequence[str] = ()
) -> DataFrame:
    """Groups of documents whose fingerprints link, directly or through others.

    Returns one row per row of ``docs``: ``doc_id``, the columns named in ``carry``, ``fp`` (long),
    ``component_id``, the least doc_id of the group, and ``class_id``, the group's least fingerprint. Null or empty texts have fingerprint 0 and link like any other. Rows that repeat give
    repeated rows. A row without doc_id takes part and gets its group's id; a group without any doc_id
    has a null component_id. An empty table gives an empty result; other columns are ignored.
    """
    marked = saved(fingerprints(docs, shingle_words, carry), "simhash-fp")
    least = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    links = saved(anchor_links(least.select("fp"), max_distance), "simhash-links")
    labels = connected_components(least.select(F.col("fp").alias("node")), links)
    named = least.join(labels.select(F.col("node").alias("fp"), "label"), "fp")
    roots = named.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = saved(named.join(roots, "label").select("fp", "component_id", F.col("label").alias("class_id")), "simhash-classes")
    return marked.join(classes, "fp").select("doc_id", *carry, "fp", "component_id", "class_id")


def as_hex(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
