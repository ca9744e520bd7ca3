"""Word spans that repeat earlier, by compaction of a De Bruijn graph of word k-mers.

**Edges.** A window of ``words`` words is an edge between its first and last ``words - 1`` words, keyed by
128 bits of hash. ``repeats`` reduces the corpus to the first occurrences of strings of windows that may be
met again; only their windows become edges. One grouping by key gives each edge its source (the first
place in order of document and position) and whether the word before it, and the word after it, is the
same in all these places: where it is not, the node at that end branches. Copies of whole strings are no
edges, and their neighbours are not seen.

**Paths.** Joined back to their places and collected by document, neighbouring edges whose common node does not branch, and which
have neighbouring sources, compact to one path; the copies of a whole string are one path already. Paths of
a document that meet, with sources that meet as well, compact again to spans (document, start, words;
source document, source start).

**Verification.** For every span, the words at its source's coordinates are read and their SHA-256 is
compared with that of the span's own words. Only verified spans are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybasket.llm import repeats
from tallybasket.llm.common import Rolling, bytes_of, discard, mixed, saved, single, steps, word_values, words_of

WORDS = 20
PART = 11


def _units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = bytes_of(texts)
    starts, ends, first = words_of(data, offsets)
    return word_values(data, starts, ends), first


EDGES = "k1 long, k2 long, ord long, rk long, pos long, ext long"


def _edges(owned: DataFrame, words: int) -> DataFrame:
    """A row per window of every owned string: key, place, and the two neighbour words.

    ``ext`` holds 32 bits of the word before and 32 of the word after; the document's ends count as words of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, own = single(batch.column("text")), single(batch.column("own"))
            ords, rks = (np.asarray(batch.column(c)) for c in ("ord", "rk"))
            for a, b in steps(texts):
                values, first = _units(texts[a:b])
                row, f = repeats.own_arrays(own[a:b])
                which, pos, _ = repeats.enumerate_windows(f["pos"], f["n"].astype(np.int64))
                row = row[which]
                at = first[row] + pos
                k1 = Rolling(values).spans(at, at + words)
                k2 = Rolling(mixed(values + np.uint64(0x632BE59BD9B4E019))).spans(at, at + words)
                before = np.where(at > first[row], values[np.maximum(at - 1, 0)], np.uint64(1)) >> np.uint64(32)
                after = np.where(at + words < first[row + 1], values[np.minimum(at + words, len(values) - 1)], np.uint64(1)) >> np.uint64(32)
                ext = (before << np.uint64(32)) | after
                columns = [k1.view(np.int64), k2.view(np.int64), ords[a:b][row], rks[a:b][row], pos, ext.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k1", "k2", "ord", "rk", "pos", "ext"])

    return owned.mapInArrow(run, EDGES)


def _compact(rows: DataFrame) -> DataFrame:
    """Spans of every document: rk, pos, n (windows), srk, spos, from its paths in ``paths`` (array).

    A path continues the one before it if both places and both sources are neighbours. Windows that several
    paths cover are in each of their spans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, f = repeats.own_arrays(single(batch.column("paths")))
            if not len(row):
                continue
            pos, n, srk, spos = f["pos"], f["n"].astype(np.int64), f["srk"], f["spos"]
            order = np.lexsort((pos, pos - spos, srk, row))
            row, pos, n, srk, spos = (x[order] for x in (row, pos, n, srk, spos))
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (srk[1:] != srk[:-1]) | (np.diff(pos - spos) != 0) | (pos[1:] > pos[:-1] + n[:-1])
            head = np.flatnonzero(new)
            end = np.maximum.reduceat(pos + n, head)
            columns = [np.asarray(batch.column("rk"))[row[head]], pos[head], (end - pos[head]).astype(np.int32), srk[head], spos[head]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["rk", "pos", "n", "srk", "spos"])

    return rows.mapInArrow(run, "rk long, pos long, n int, srk long, spos long")


def _paths(places: DataFrame) -> DataFrame:
    """Paths of repeated edges in every owning document: rk, pos, n, srk, spos.

    ``places`` has per document an array of edges: pos, srk, spos, left, right (whether the node there is free
    of branches), repeated ones only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, f = repeats.own_arrays(single(batch.column("edges")))
            if not len(row):
                continue
            order = np.lexsort((f["pos"], row))
            row = row[order]
            pos, srk, spos, left, right = (f[c][order] for c in ("pos", "srk", "spos", "left", "right"))
            new = np.ones(len(row), bool)
            joined = (row[1:] == row[:-1]) & (np.diff(pos) == 1) & (srk[1:] == srk[:-1]) & (np.diff(spos) == 1)
            new[1:] = ~(joined & np.asarray(right[:-1], bool) & np.asarray(left[1:], bool))
            head = np.flatnonzero(new)
            n = np.diff(np.r_[head, len(row)]).astype(np.int32)
            columns = [np.asarray(batch.column("rk"))[row[head]], pos[head], n, srk[head], spos[head]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["rk", "pos", "n", "srk", "spos"])

    return places.mapInArrow(run, "rk long, pos long, n int, srk long, spos long")


def _span_digests(rows: DataFrame, words: int) -> DataFrame:
    """SHA-256 of the words of spans: srk, spos, n, sha; ``rows`` has text, rk and ``asked`` (array of spos, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"srk": [], "spos": [], "n": [], "sha": []}
            for rk, text, asked in zip(batch.column("rk").to_pylist(), batch.column("text"), batch.column("asked")):
                line = _Words(text.as_buffer().to_pybytes())
                for spos, n in zip(asked.values.field("spos").to_pylist(), asked.values.field("n").to_pylist()):
                    out["srk"].append(rk)
                    out["spos"].append(spos)
                    out["n"].append(n)
                    out["sha"].append(line.digest(spos, spos + n - 1 + words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["srk"], pa.int64()), pa.array(out["spos"], pa.int64()), pa.array(out["n"], pa.int32()), pa.array(out["sha"], pa.binary())],
                names=["srk", "spos", "n", "sha"],
            )

    return rows.mapInArrow(run, "srk long, spos long, n int, sha binary")


class _Words:
    """The words of one text, joined by one space."""

    def __init__(self, raw: bytes):
        data = np.frombuffer(raw, np.uint8)
        starts, ends, _ = words_of(data, np.array([0, len(data)]))
        self.n = len(starts)
        self.line = b" ".join(raw[i:j] for i, j in zip(starts.tolist(), ends.tolist()))
        self.at = np.zeros(self.n + 1, np.int64)
        np.cumsum(ends - starts + 1, out=self.at[1:])

    def digest(self, start: int, end: int) -> bytes:
        return hashlib.sha256(self.line[self.at[start] : self.at[end] - 1]).digest()

    def without(self, gone: np.ndarray) -> bytes:
        if not gone.any():
            return self.line
        edges = np.flatnonzero(np.diff(np.r_[True, gone, True].astype(np.int8))).reshape(-1, 2)
        return b" ".join(self.line[self.at[a] : self.at[b] - 1] for a, b in edges.tolist())


def verified_spans(rows: DataFrame, words: int = WORDS, part: int = PART) -> DataFrame:
    """``rk`` and ``spans`` (array of pos, n in windows, sha of the source's words) of documents that repeat something."""
    rows, kept = repeats.once_each(rows, "debruijn")
    near, first = repeats.candidates(rows, _units, words, part, "debruijn")
    copied = repeats.copies(near, first).select("rk", "pos", "n", F.col("src.rk").alias("srk"), F.col("src.pos").alias("spos"))
    marked, shared = repeats.contested(first, "debruijn")
    edges = saved(_edges(repeats.with_text(marked, rows), words), "debruijn-edges")
    both, any_bit = F.bit_and("ext"), F.bit_or("ext")
    met = edges.groupBy("k1", "k2").agg(
        F.min(F.struct("ord", "rk", "pos")).alias("src"), F.count("*").alias("c"), both.bitwiseXOR(any_bit).alias("differ")
    )
    met = saved(met.where(F.col("c") > 1).drop("c"), "debruijn-met")
    here = F.struct("ord", "rk", "pos")
    placed = edges.join(met, ["k1", "k2"]).where(here != F.col("src"))
    edge = F.struct(
        "pos",
        F.col("src.rk").alias("srk"),
        F.col("src.pos").alias("spos"),
        (F.shiftrightunsigned("differ", 32) == 0).alias("left"),
        (F.col("differ").bitwiseAND(F.lit(0xFFFFFFFF)) == 0).alias("right"),
    )
    paths = _paths(placed.groupBy("rk").agg(F.collect_list(edge).alias("edges")))
    glued = copied.unionByName(paths).groupBy("rk").agg(F.collect_list(F.struct("pos", "n", "srk", "spos")).alias("paths"))
    spans = saved(_compact(glued), "debruijn-spans")
    discard(near, first, shared, edges, met)
    asked = spans.select("srk", "spos", "n").distinct().groupBy(F.col("srk").alias("rk"))
    asked = asked.agg(F.collect_list(F.struct("spos", "n")).alias("asked"))
    digests = saved(_span_digests(rows.select("rk", "text").join(asked, "rk"), words).distinct(), "debruijn-digests")
    discard(*kept)
    checked = spans.join(digests, ["srk", "spos", "n"])
    return checked.groupBy("rk").agg(F.collect_list(F.struct("pos", "n", "sha")).alias("spans"))


def remove_repeats(docs: DataFrame, words: int = WORDS, keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` without the words of windows that start earlier.

    Returns doc_id, n_words, n_removed, removed (array of start, end, in words), kept_sha256 (of the kept words
    joined by one space) and, if ``keep_text``, kept_text. Null texts have no words; windows never cross
    documents and are judged on the input. Rows with one id are ordered by a hash of id and text, rows
    without id come last, rows that agree in id and text are one document and give equal results. An empty
    table gives an empty result; other columns are ignored.
    """
    rows = repeats.documents(docs)
    spans = saved(verified_spans(rows, words), "debruijn-verified")
    joined = rows.select("doc_id", "rk", "text").join(spans, "rk", "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept_sha256 string"
    schema += ", kept_text string" if keep_text else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("n_words", "n_removed", "removed", "kept_sha256", "kept_text")}
            for text, own in zip(single(batch.column("text")), single(batch.column("spans"))):
                line = _Words(text.as_buffer().to_pybytes())
                gone = np.zeros(line.n, bool)
                if own.is_valid:
                    pos, n = (np.asarray(own.values.field(c)).astype(np.int64) for c in ("pos", "n"))
                    end = pos + n - 1 + words
                    true = [line.digest(i, j) == sha for i, j, sha in zip(pos.tolist(), end.tolist(), own.values.field("sha").to_pylist())]
                    gone = repeats.union(pos[true], end[true], line.n)
                kept = line.without(gone)
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).reshape(-1, 2)
                out["n_words"].append(line.n)
                out["n_removed"].append(int(gone.sum()))
                out["removed"].append([{"start": a, "end": b} for a, b in edges.tolist()])
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    out["kept_text"].append(kept.decode("utf-8"))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column("doc_id"), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64())]
            columns += [pa.array(out["removed"], kind), pa.array(out["kept_sha256"], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "removed", "kept_sha256"]
            if keep_text:
                columns.append(pa.array(out["kept_text"], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, schema)
