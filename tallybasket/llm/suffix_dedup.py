"""Byte spans that repeat earlier, by equal neighbours in suffix order.

Every text is taken as UTF-8 bytes. ``repeats`` reduces the corpus to the first occurrences of the strings
that may share a window of ``length`` bytes. Their windows are suffixes cut to ``length`` bytes. A task
brings those of its groups into suffix order, ties in order of position (document, then place). Arrays of
smaller positions and of longest previous factors are not computed: a previous factor of ``length`` bytes
exists exactly if the suffix before it in the order equals it, as ties are ordered by position. Such windows are later copies; the bytes they cover are removed, the first stay.

Groups of strings are those of one ``m``. A group of more than ``GROUP_STRINGS`` different strings (a
passage in a large part of all documents, each time with other text beside it) is split: its windows
go by the hash of their bytes to as many groups, where equal ones still meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybasket.llm import repeats
from tallybasket.llm.common import Rolling, byte_values, bytes_of, discard, saved, single, steps

LENGTH = 100
PART = 32
GROUP_STRINGS = 1000
#: Shares of the strings, and then of the groups, that are looked at one after another. Strings of a share are found anew in the
#: texts, so that only one share's rows and exchanges are on disk at a time, beside the results of those before.
SHARES = 4
#: Windows that a task sorts at a time, whole groups and so at most about twice as many.
SORT_WINDOWS = 100_000


def _units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = bytes_of(texts)
    return byte_values(data), offsets


def previous_factors(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For suffixes given in order of position: whether an earlier one agrees with it in ``length`` bytes."""
    if not len(starts):
        return np.zeros(0, bool)
    view = np.lib.stride_tricks.sliding_window_view(data, length)[starts]
    keys = np.ascontiguousarray(view).view(f"V{length}").ravel()
    # Big-endian words of eight bytes compare like the bytes; ties keep their order of position.
    words = np.zeros((len(starts), -(-length // 8) * 8), np.uint8)
    words[:, :length] = view
    columns = words.view(">u8").astype(np.uint64)
    order = np.arange(len(starts))
    for c in range(columns.shape[1] - 1, -1, -1):
        order = order[np.argsort(columns[order, c], kind="stable")]
    same = np.r_[False, keys[order[1:]] == keys[order[:-1]]]
    later = np.zeros(len(starts), bool)
    later[order] = same
    return later


BODIES = "grp long, ord long, rk long, pos long, n int, body binary"


def _bodies(owned: DataFrame, length: int) -> DataFrame:
    """The bytes of every first occurrence: grp, ord, rk, pos (of the first window), n (windows), body.

    ``owned`` has ``own`` with field ``hot``: strings of split groups come as single windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, own = single(batch.column("text")), single(batch.column("own"))
            ords, rks = (np.asarray(batch.column(c)) for c in ("ord", "rk"))
            for a, b in steps(texts):
                data, offsets = bytes_of(texts[a:b])
                row, f = repeats.own_arrays(own[a:b])
                hot = np.asarray(f["hot"], bool)
                group, pos, n = f["m"].copy(), f["pos"], f["n"].astype(np.int64)
                if hot.any():
                    which, window, _ = repeats.enumerate_windows(pos[hot], n[hot])
                    hot_row = row[hot][which]
                    rolling = Rolling(byte_values(data))
                    at = offsets[hot_row] + window
                    key = rolling.spans(at, at + length).view(np.int64)
                    row, pos = np.r_[row[~hot], hot_row], np.r_[pos[~hot], window]
                    n, group = np.r_[n[~hot], np.ones(len(window), np.int64)], np.r_[group[~hot], key]
                begin = offsets[row] + pos
                raw = data.tobytes()
                bodies = [raw[i:j] for i, j in zip(begin.tolist(), (begin + n + length - 1).tolist())]
                columns = [group, ords[a:b][row], rks[a:b][row], pos, n.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(bodies, pa.binary())], names=["grp", "ord", "rk", "pos", "n", "body"])

    return owned.mapInArrow(run, BODIES)


def _later_windows(bodies: DataFrame, length: int) -> DataFrame:
    """Runs of windows that start earlier elsewhere: rk, pos, n. ``bodies`` is partitioned and sorted by grp."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        table = table.sort_by([("ord", "ascending"), ("rk", "ascending"), ("pos", "ascending")]).combine_chunks()
        data, offsets = bytes_of(single(table.column("body")))
        n = np.asarray(table.column("n")).astype(np.int64)
        run, starts, offset = repeats.enumerate_windows(offsets[:-1], n)
        rk, pos = np.asarray(table.column("rk")), np.asarray(table.column("pos"))
        later = np.flatnonzero(previous_factors(data, starts, length))
        # Neighbours of one string become one run.
        head = np.r_[True, (np.diff(later) != 1) | (np.diff(run[later]) != 0)] if len(later) else np.zeros(0, bool)
        heads = np.flatnonzero(head)
        first = later[heads]
        columns = [rk[run[first]], pos[run[first]] + offset[first], np.diff(np.r_[heads, len(later)]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["rk", "pos", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        windows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                waiting.append(part)
                windows += int(np.asarray(part.column("n")).sum())
                if windows < SORT_WINDOWS:
                    continue
                table = pa.Table.from_batches(waiting).combine_chunks()
                group = np.asarray(table.column("grp"))
                # The last group may go on in the next batch.
                cut = int(np.searchsorted(group, group[-1], side="left"))
                if cut:
                    yield solve(table.slice(0, cut))
                    table = table.slice(cut).combine_chunks()
                waiting = table.to_batches()
                windows = int(np.asarray(table.column("n")).sum()) if table.num_rows else 0
        if waiting:
            yield solve(pa.Table.from_batches(waiting))

    return bodies.mapInArrow(run, "rk long, pos long, n int")


def repeated_spans(docs: DataFrame, length: int = LENGTH, part: int = PART, group_strings: int = GROUP_STRINGS) -> DataFrame:
    """``rk`` and ``spans`` (array of pos, n: runs of windows that start earlier) of documents with any.

    ``docs`` comes from ``repeats.documents``.
    """
    docs, kept = repeats.once_each(docs, "suffix")
    near_to, again = [], []
    for i in range(SHARES):
        near, first = repeats.candidates(docs, _units, length, part, "suffix", (i, SHARES))
        marked, shared = repeats.contested(first, "suffix")
        hot = (F.col("strings") > group_strings).alias("hot")
        near_to.append(saved(marked.select("m", F.col("src.rk").alias("rk"), F.col("src.pos").alias("pos"), "n", hot), "suffix-contested"))
        again.append(saved(repeats.copies(near, first).select("rk", "pos", "n"), "suffix-copies"))
        discard(near, first, shared)
    marked = reduce(DataFrame.unionByName, near_to)
    own = marked.groupBy("rk").agg(F.collect_list(F.struct("m", "pos", "n", "hot")).alias("own"))
    owned = docs.join(own, "rk")
    bodies = saved(_bodies(owned, length), "suffix-bodies")
    discard(*near_to)
    later = []
    for i in range(SHARES):
        mine = bodies.where(F.pmod("grp", F.lit(SHARES)) == i)
        # Windows of split groups that many documents share are collapsed to the earliest before they meet.
        alone = mine.where(F.col("n") == 1)
        least = saved(alone.groupBy("grp", "body").agg(F.min(F.struct("ord", "rk", "pos")).alias("src")), "suffix-windows")
        repeated = alone.join(least.select("grp", "body", "src"), ["grp", "body"]).where(F.struct("ord", "rk", "pos") != F.col("src"))
        whole = mine.where(F.col("n") > 1).unionByName(
            least.select("grp", "src.ord", "src.rk", "src.pos", F.lit(1).alias("n"), "body")
        )
        found = _later_windows(whole.repartition("grp").sortWithinPartitions("grp"), length)
        later.append(saved(found.unionByName(repeated.select("rk", "pos", "n")), "suffix-later"))
        discard(least)
    discard(bodies, *kept)
    found = reduce(DataFrame.unionByName, [*again, *later])
    spans = saved(found.groupBy("rk").agg(F.collect_list(F.struct("pos", "n")).alias("spans")), "suffix-spans")
    discard(*later, *again)
    return spans


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, keep_text: bool = True, carry: Sequence[str] = ()
) -> DataFrame:
    """Every row of ``docs`` without the bytes of windows that start earlier.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), removed (array of start, end, in bytes),
    kept_sha256 (of the remaining bytes) and, if ``keep_text``, kept_text: the remaining bytes as text, where
    bytes of characters that a removal cut through are left out. ``was_null`` marks rows without a text. Null texts count as empty; matches never
    cross documents. Rows with one id are ordered by a hash of id and text, rows without id come last,
    rows that agree in id and text are one document and give equal results. An empty table gives an empty
    result; other columns are ignored, but for those named in ``carry``, which are handed through. The result
    does not depend on ``part`` or group sizes.
    """
    rows = repeats.documents(docs, carry)
    spans = repeated_spans(rows, length)
    handed = ["doc_id", "was_null", *carry]
    joined = rows.select(*handed, "rk", "text").join(spans, "rk", "left").select(*handed, "text", "spans")
    added = T.StructType.fromDDL(
        "n_bytes long, n_removed long, n_spans long, removed array<struct<start:long,end:long>>, kept_sha256 string"
        + (", kept_text string" if keep_text else "")
    )
    schema = T.StructType([f for f in joined.schema.fields if f.name in handed] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "removed", "kept_sha256", "kept_text")}
            for text, own in zip(single(batch.column("text")), single(batch.column("spans"))):
                raw = text.as_buffer().to_pybytes() if text.as_buffer() is not None else b""
                runs: list[dict[str, int]] = []
                kept = raw
                if own.is_valid and len(own):
                    pos, n = (np.asarray(own.values.field(c)).astype(np.int64) for c in ("pos", "n"))
                    gone = repeats.union(pos, pos + n - 1 + length, len(raw))
                    edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                    runs = [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(kept))
                out["n_spans"].append(len(runs))
                out["removed"].append(runs)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    out["kept_text"].append(kept.decode("utf-8", errors="ignore"))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column(c) for c in handed]
            columns += [pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")]
            columns += [pa.array(out["removed"], kind), pa.array(out["kept_sha256"], pa.string())]
            names = [*handed, "n_bytes", "n_removed", "n_spans", "removed", "kept_sha256"]
            if keep_text:
                columns.append(pa.array(out["kept_text"], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, schema)
