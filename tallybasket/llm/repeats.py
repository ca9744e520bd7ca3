"""Spans of fixed length that repeat earlier, over sequences of any units, without a row for every position.

A *window* is ``length`` consecutive units of one document. Every window has a *least part*: the k-gram
in it with the smallest hash, the leftmost among equals. Consecutive windows with the same least part form
one *string*. Equal windows have equal least parts at equal places, so all their occurrences lie in strings
with one and the same hash ``m``, and strings whose ``m`` is met once need no further look.

Documents are ordered by ``(ord, rk)``: ``ord`` is the doc_id, or the greatest long for a null one; ``rk``
hashes id and text, so rows that share an id are ordered by it, and rows that agree in both are the same
document. Strings of equal content share ``(m, g)``, 128 bits; their first occurrence stands for all, which
collapses copied documents and passages however many there are, with partial sums before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybasket.llm.common import Rolling, discard, mixed, prepare_tasks, row_key, saved, single, sliding_least, steps, text_or_empty
from tallybasket.llm.statistics import repeated

LAST = (1 << 63) - 1

#: For the texts of a step: the values of all units, and for each text the index of its first unit (and the end).
Units = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def documents(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``was_null``, the columns in ``carry``, ``text`` (null: empty), ``ord`` and ``rk``."""
    prepare_tasks(docs.sparkSession)
    doc_id, was_null = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").isNull().alias("was_null")
    rows = docs.select(doc_id, was_null, *carry, text_or_empty().alias("text"))
    return rows.withColumn("ord", F.coalesce("doc_id", F.lit(LAST))).withColumn("rk", row_key())


def once_each(rows: DataFrame, name: str) -> tuple[DataFrame, tuple[DataFrame, ...]]:
    """``ord``, ``rk`` and ``text``, one row for each ``rk``; and the tables that this reads, to discard.

    Only the texts of repeated rows are shuffled, and those once for each task.
    """
    rows = rows.select("ord", "rk", "text")
    keys = rows.groupBy("rk").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1).select("rk")
    keys = saved(keys, f"{name}-repeated")
    merged = rows.join(keys, "rk", "left_semi").groupBy("rk").agg(F.min("ord").alias("ord"), F.min("text").alias("text"))
    merged = saved(merged.select("ord", "rk", "text"), f"{name}-merged")
    return rows.join(keys, "rk", "left_anti").select("ord", "rk", "text").unionByName(merged), (keys, merged)


def runs_of(rolling: Rolling, first: np.ndarray, length: int, part: int) -> tuple[np.ndarray, ...]:
    """All strings of some documents: owner, first window, number of windows, m."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(owner) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    parts = rolling.windows(part)
    least = sliding_least(parts, length - part + 1)
    n = len(least)
    valid = owner[:n] == owner[length - 1 :]
    begins = np.ones(n, bool)
    # A string also ends where its least part leaves the window, even if an equal one follows.
    begins[1:] = ~valid[:-1] | (least[1:] != least[:-1]) | (parts[: n - 1] == least[:-1])
    begins[1:] |= owner[1:n] != owner[: n - 1]
    at = np.flatnonzero(valid)
    heads = np.flatnonzero(begins[at])
    starts = at[heads]
    return owner[starts], starts, np.diff(np.r_[heads, len(at)]), least[starts]


def strings(docs: DataFrame, units: Units, length: int, part: int, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """A row for every string: m, g, ord, rk, pos (of its first window), n (windows), again (not the document's first).

    ``share`` (i, of) keeps the strings whose ``m`` leaves i when divided by that number: all those of an ``m``, or none.
    """
    which, of = np.uint64(share[0]), np.uint64(share[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = single(batch.column("text"))
            ords, rks = (np.asarray(batch.column(c)) for c in ("ord", "rk"))
            for a, b in steps(texts):
                values, first = units(texts[a:b])
                rolling = Rolling(values)
                owner, starts, n, m = runs_of(rolling, first, length, part)
                if share[1] > 1:
                    mine = np.flatnonzero(m % of == which)
                    owner, starts, n, m = owner[mine], starts[mine], n[mine], m[mine]
                g = rolling.spans(starts, starts + n + length - 1)
                again = repeated(owner, mixed(m) + g)[1]
                columns = [m.view(np.int64), g.view(np.int64), ords[a:b][owner], rks[a:b][owner], starts - first[owner], n.astype(np.int32), again]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["m", "g", "ord", "rk", "pos", "n", "again"])

    return docs.select("ord", "rk", "text").mapInArrow(run, "m long, g long, ord long, rk long, pos long, n int, again boolean")


def candidates(
    docs: DataFrame, units: Units, length: int, part: int, name: str, share: tuple[int, int] = (0, 1)
) -> tuple[DataFrame, DataFrame]:
    """The strings of a share whose ``m`` is met more than once, and the first occurrence of each (both written).

    The second has m, g, n and ``src`` (struct of ord, rk, pos).
    """
    every = saved(strings(docs, units, length, part, share), f"{name}-strings")
    met = saved(every.groupBy("m").agg(F.count("*").alias("c")).where(F.col("c") > 1).select("m"), f"{name}-met")
    near = saved(every.join(met, "m", "left_semi"), f"{name}-near")
    discard(every, met)
    first = near.groupBy("m", "g").agg(F.min(F.struct("ord", "rk", "pos")).alias("src"), F.max("n").alias("n"))
    return near, saved(first, f"{name}-first")


def contested(first: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """First occurrences of strings whose ``m`` other strings have too, with their number ``strings``; and the table of these m.

    Equal windows lie in strings of one m, at one place from the least part; so a string that is the only one
    of its m shares a window with none but its own copies.
    """
    shared = first.groupBy("m").agg(F.count(F.lit(1)).alias("strings")).where(F.col("strings") > 1)
    shared = saved(shared, f"{name}-shared")
    return first.join(shared, "m"), shared


def copies(near: DataFrame, first: DataFrame) -> DataFrame:
    """Occurrences of strings after their first: rk, pos, n, src."""
    found = near.join(first.select("m", "g", "src"), ["m", "g"])
    here = F.struct("ord", "rk", "pos")
    return found.where(here != F.col("src")).select("rk", "pos", "n", "src")


def with_text(first: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per document that owns first occurrences: ord, rk, text and ``own`` (array of m, g, pos, n)."""
    own = first.groupBy(F.col("src.rk").alias("rk")).agg(F.collect_list(F.struct("m", "g", F.col("src.pos").alias("pos"), "n")).alias("own"))
    return docs.select("ord", "rk", "text").join(own, "rk")


def own_arrays(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Of a list-of-structs column: the row of every entry, and its fields."""
    flat = column.flatten()
    counts = np.diff(np.asarray(column.offsets))
    fields = {f.name: np.asarray(flat.field(f.name)) for f in flat.type}
    return np.repeat(np.arange(len(column)), counts), fields


def enumerate_windows(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of consecutive numbers: the run of every number, the number, and its offset in the run."""
    run = np.repeat(np.arange(len(starts)), counts)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    return run, starts[run] + offset, offset


def union(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` units lie in any of the spans."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:size]) > 0
