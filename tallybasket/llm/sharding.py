"""Shards of near-equal bytes by histogram sort: probes, exact counts below them, one exchange.

Rows are ordered by the key ``(k1, k2)``: ``k1`` hashes the text, so equal texts are neighbours and form a
*group*; ``k2`` tells the rows of a group apart. Splitters between shards are found in rounds. A round
sends candidate boundaries (*probes*) to all tasks, which count bytes and rows below each in one pass over
the narrow keys; partial sums of the histogram meet in Spark. Each splitter then lies between two neighbouring
probes, and the next round places its probes there, until the bytes below it are within the tolerance. A
boundary cuts into a group only where the group is too large to leave whole.

Shards are subdivided into *parts* of bounded rows and bytes by the same rounds, with a loose tolerance. Rows go to
their part in one exchange and are sorted there; the histogram has the rows before each part, so a row's
slot in its shard is known without bringing a shard together.

The driver holds splitters and probes alone: at most ``MAX_PARTS`` and a fixed multiple of it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybasket.llm.common import prepare_tasks, saved, text_or_empty

#: Bytes a shard may differ from its share, as a part of that share; a larger document or none is the exception.
TOLERANCE = 0.001
#: Bounds of a part, and how many parts there are at most (beyond, parts grow).
PART_ROWS, PART_BYTES, LEAST_PARTS, MAX_PARTS = 250_000, 128 << 20, 64, 1 << 16
#: Probes of the first round over the whole range, and those of later rounds for each open shard splitter and part splitter.
GRID, SHARD_PROBES, PART_PROBES = 1 << 14, 63, 7
LOW, HIGH = -(1 << 63), (1 << 63) - 1
_OUT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def keyed(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``k1``, ``k2`` and the columns in ``carry``, written once.

    ``k2`` is 40 bits of a hash of id and carried columns, then 24 bits of the row's place: rows that repeat in full are
    spread as well, and are the only ones (but for hash collisions) whose order another layout of the files changes.
    """
    clash = set(carry) & {*_OUT, "doc_id", "k1", "k2"}
    if clash:
        raise ValueError(f"carried columns clash with results: {sorted(clash)}")
    body = text_or_empty()
    own = F.xxhash64(F.col("doc_id").cast("long"), *carry)
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND((1 << 24) - 1)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.least(F.xxhash64(body), F.lit(HIGH - 1)).alias("k1"),  # all keys lie below (HIGH, LOW)
        own.bitwiseAND(~((1 << 24) - 1)).bitwiseOR(place).alias("k2"),
        *carry,
    )


def below(k1: np.ndarray, k2: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """For every key the number of probes, sorted by (p1, p2), that are not above it."""
    first, last = np.searchsorted(p1, k1, side="left"), np.searchsorted(p1, k1, side="right")
    inside = np.flatnonzero(first < last)
    found = first.copy()
    for a in np.unique(first[inside]):
        rows = inside[first[inside] == a]
        found[rows] = a + np.searchsorted(p2[a : last[rows[0]]], k2[rows], side="right")
    return found


def histogram(keys: DataFrame, p1: np.ndarray, p2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below every probe; at most as many rows as probes come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(p1) + 1, np.int64), np.zeros(len(p1) + 1, np.int64)
        for batch in batches:
            at = below(np.asarray(batch.column("k1")), np.asarray(batch.column("k2")), p1, p2)
            np.add.at(size, at, np.asarray(batch.column("size")))
            rows += np.bincount(at, minlength=len(rows))
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(size[full]), pa.array(rows[full])], names=["at", "size", "rows"])

    found = keys.select("k1", "k2", "size").mapInArrow(count, "at long, size long, rows long")
    sums = found.groupBy("at").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).toArrow()
    size, rows = np.zeros(len(p1) + 1, np.int64), np.zeros(len(p1) + 1, np.int64)
    at = np.asarray(sums["at"])
    size[at], rows[at] = np.asarray(sums["size"]), np.asarray(sums["rows"])
    return np.cumsum(size)[:-1], np.cumsum(rows)[:-1]


class Splitter:
    """A boundary that is looked for: ``low`` has at most ``target`` below it, ``high`` more. Keys are pairs of ints."""

    def __init__(self, target: float, tolerance: float, total: int, rows: int, shard: bool):
        self.target, self.tolerance, self.shard = target, tolerance, shard
        self.low, self.high = (LOW, LOW), (HIGH, LOW)
        self.low_value, self.high_value = 0, total
        self.low_rows, self.high_rows = 0, rows

    def see(self, key: tuple[int, int], value: int, rows: int) -> None:
        if value <= self.target:
            if (value, key) >= (self.low_value, self.low):
                self.low, self.low_value, self.low_rows = key, value, rows
        elif (value, key) < (self.high_value, self.high):
            self.high, self.high_value, self.high_rows = key, value, rows

    @property
    def best(self) -> tuple[tuple[int, int], int]:
        """The nearer of both sides, with the rows below it."""
        if self.target - self.low_value <= self.high_value - self.target:
            return self.low, self.low_rows
        return self.high, self.high_rows

    @property
    def done(self) -> bool:
        gap = min(self.target - self.low_value, self.high_value - self.target)
        return gap <= self.tolerance or self.high_rows - self.low_rows <= 1 or not self.room

    @property
    def room(self) -> bool:
        """Whether any key lies strictly between both sides."""
        (a, b), (c, d) = self.low, self.high
        return c - a > 1 or (c == a and d - b > 1) or (c == a + 1 and b < HIGH)

    def probes(self, n: int) -> list[tuple[int, int]]:
        """Keys strictly between both sides: whole groups as long as there are any, then keys of the one group."""
        (a, b), (c, d) = self.low, self.high
        if c - a > 1:
            steps = min(n, c - a - 1)
            return [(a + (c - a) * i // (steps + 1), LOW) for i in range(1, steps + 1)]
        end = d if c == a else HIGH + 1
        steps = min(n, end - b - 1)
        return [(a, b + (end - b) * i // (steps + 1)) for i in range(1, steps + 1)]


def find_splitters(keys: DataFrame, shards: int, tolerance: float, parts: int | None = None) -> list[tuple[tuple[int, int], int, bool]]:
    """(key, rows below it, whether a shard begins there) in order of key; [] without rows. Shard splitters come ``shards - 1`` times."""
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not rows:
        return []
    parts = parts or min(MAX_PARTS, max(LEAST_PARTS, -(-rows // PART_ROWS), -(-total // PART_BYTES)))
    # Parts weigh rows and bytes alike: each counts as much as the other over the whole table.
    weight = 2 * total * rows
    wanted = [Splitter(total * j / shards, tolerance * total / shards, total, rows, True) for j in range(1, shards)]
    wanted += [Splitter(weight * j / parts, weight / parts / 4, weight, rows, False) for j in range(1, parts)]
    grid = [(LOW + (1 << 64) * i // GRID, LOW) for i in range(1, GRID)]
    while True:
        probes = grid or sorted({p for s in wanted if not s.done for p in s.probes(SHARD_PROBES if s.shard else PART_PROBES)})
        grid = []
        if not probes:
            break
        p1, p2 = (np.array([p[i] for p in probes], np.int64) for i in (0, 1))
        size, count = histogram(keys, p1, p2)
        both = size.astype(object) * rows + count.astype(object) * total
        for s in wanted:
            values = size if s.shard else both
            # The last probe at or below the target and the first above it are all that can narrow the splitter.
            at = int(np.searchsorted(values, s.target, side="right"))
            for i in {at - 1, at} & set(range(len(probes))):
                s.see(probes[i], int(values[i]), int(count[i]))
    return sorted((*s.best, s.shard) for s in wanted)


def shard_by_bytes(docs: DataFrame, shards: int = 16, tolerance: float = TOLERANCE, carry: Sequence[str] = ()) -> DataFrame:
    """Every row of ``docs`` with its shard, in shards of near-equal bytes.

    Returns doc_id, size (UTF-8 bytes of the text, null: none, plus 1), text_crc32 (unsigned; null counts as empty), law
    (``bytes``), shard (0 to ``shards`` - 1, in order of key), slot (gapless from 0 in each shard, in order of key), grown_shard (null:
    this law moves rows between all shards when there is one more) and the columns in ``carry``, such as ``text``.
    The bytes before a shard differ from its share by at most ``tolerance`` of a shard, or by half of one row where a
    row is larger than that. Rows with equal text stay in one shard unless only a cut through them meets the
    tolerance. Rows that repeat in full are rows of their own. Rows without id or text count like others. An empty
    table gives an empty result, a table with fewer rows than shards leaves shards empty; columns not named in
    ``carry`` are ignored; a carried column named like a result is refused.
    """
    prepare_tasks(docs.sparkSession)
    keys = saved(keyed(docs, carry), "shard-keys")
    splitters = find_splitters(keys, shards, tolerance)
    s1, s2 = (np.array([key[i] for key, _, _ in splitters], np.int64) if splitters else np.zeros(0, np.int64) for i in (0, 1))
    shard = np.cumsum([0, *(begins for _, _, begins in splitters)])
    before = np.array([0, *(n for _, n, _ in splitters)], np.int64)
    # Rows before the shard of each part: those before the last part that begins a shard.
    begins = np.maximum.accumulate(np.r_[0, [i + 1 if b else 0 for i, (_, _, b) in enumerate(splitters)]]).astype(np.int64)
    base = before - before[begins]
    fields = [f for f in keys.schema.fields]
    names = [f.name for f in fields]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = below(np.asarray(batch.column("k1")), np.asarray(batch.column("k2")), s1, s2)
            columns = [batch.column(c) for c in names]
            columns += [pa.array(part), pa.array(shard[part].astype(np.int32)), pa.array(base[part])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_part", "shard", "_base"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", _part long, shard int, _base long"
    order = Window.partitionBy("_part").orderBy("k1", "k2", "doc_id")
    slot = F.col("_base") + F.row_number().over(order) - 1
    return keys.mapInArrow(place, schema).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *carry
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, tolerance: float = TOLERANCE, carry: Sequence[str] = ("text",)) -> None:
    """Write the shards as Parquet folders ``shard=N`` under ``path``, each file in order of slot."""
    placed = shard_by_bytes(docs, shards, tolerance, carry)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
