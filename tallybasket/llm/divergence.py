"""How the sources of a language differ in their terms, by counts over length-bucketed packed terms.

A *term* is a run of ASCII letters, lower-cased, and characters beyond ASCII. A batch puts its rows in order of
(language, source), finds all terms on the UTF-8 bytes and packs them by length: up to 8 bytes are one
big-endian 64-bit word, up to 16 are two, and longer terms go to one bucket for each length in bytes. Zero bytes fill
the words, which is exact because no term holds one. Words are ordered by a stable radix sort over 16-bit digits, long
terms by their bytes, so that equal terms stand together and, within them, groups and documents keep their order; runs
are then counts of occurrences and of documents. Spark adds up these counts and never sees single occurrences.

Each kept term becomes one row with its count in every source that has it. Shares and divergences are whole numbers: a
share is computed with more than 64 bits where its count needs them, and a squared difference of shares has at most 60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybasket.llm.common import bytes_of, prepare_tasks, saved, single, text_or_empty

MIN_DOCS, TOP = 10, 10
#: Shares are per this many.
UNIT = 1_000_000_000
#: Counts beyond this would pass 64 bits times ``UNIT``.
_NARROW = 9_000_000_000
#: Cells (terms times sources) that the comparison of sources holds at a time.
CELLS = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all terms; none crosses an offset."""
    letter = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.r_[True, ~letter[:-1]] | edge[:-1]
    after = np.r_[~letter[1:], True] | edge[1:]
    return np.flatnonzero(letter & before), np.flatnonzero(letter & after) + 1


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: int) -> list[np.ndarray]:
    """Terms of at most 8 ``words`` bytes as so many 64-bit words, the first the most significant. ``data`` has 16 spare bytes."""
    raw = data[starts[:, None] + np.arange(8 * words)]
    raw[np.arange(8 * words) >= lengths[:, None]] = 0
    columns = raw.view(">u8").astype(np.uint64)
    return [np.ascontiguousarray(columns[:, i]) for i in range(words)]


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order by the words, the first the most significant, by counting sorts over their 16-bit digits."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(equal: list[np.ndarray]) -> np.ndarray:
    """Where a new run begins in columns that stand in order."""
    begin = np.zeros(len(equal[0]), bool)
    begin[:1] = True
    for column in equal:
        begin[1:] |= column[1:] != column[:-1]
    return begin


def buckets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each bucket of lengths: its terms in order of their bytes, equal ones as given, and where a new term begins."""
    lengths = ends - starts
    spare = np.r_[data, np.zeros(16, np.uint8)]
    for least, most in ((1, 8), (9, 16)):
        rows = np.flatnonzero((lengths >= least) & (lengths <= most))
        if len(rows):
            words = packed(spare, starts[rows], lengths[rows], most // 8)
            order = radix_order(words)
            yield rows[order], _runs([word[order] for word in words])
    for size in np.unique(lengths[lengths > 16]).tolist():
        rows = np.flatnonzero(lengths == size)
        raw = data[starts[rows][:, None] + np.arange(size)].view(f"S{size}").ravel()
        order = np.argsort(raw, kind="stable")
        yield rows[order], _runs([raw[order]])


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of ``data`` as strings."""
    offsets = np.r_[0, np.cumsum(ends - starts)]
    taken = data[np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(taken)]).cast(pa.string())


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, c (occurrences) and d (documents), several rows for a term: one for each batch it stands in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source = (single(batch.column(c)).dictionary_encode() for c in ("lang", "source"))
            codes = [np.asarray(x.indices).astype(np.int64) for x in (lang, source)]
            n_sources = max(1, len(source.dictionary))
            group = codes[0] * n_sources + codes[1]
            rows = np.argsort(group, kind="stable")
            group = group[rows]
            data, offsets = bytes_of(single(batch.column("text")).take(pa.array(rows)))
            starts, ends = terms_of(data, offsets)
            data = _LOWER[data]
            owner = np.searchsorted(offsets, starts, side="right") - 1
            for order, begins in buckets(data, starts, ends):
                # Equal terms stand in order of document, and documents in order of group.
                number = np.cumsum(begins)
                head = np.flatnonzero(_runs([number, group[owner[order]]]))
                c = np.diff(np.r_[head, len(order)])
                d = np.add.reduceat(_runs([number, owner[order]]), head, dtype=np.int64)
                first = order[head]
                groups = group[owner[first]]
                columns = [lang.dictionary.take(pa.array(groups // n_sources)), source.dictionary.take(pa.array(groups % n_sources))]
                columns += [slices(data, starts[first], ends[first]), pa.array(c.astype(np.int64)), pa.array(d)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "c", "d"])

    return docs.mapInArrow(run, "lang string, source string, term string, c long, d long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, total and ``cells`` (source, c) of every term in at least ``min_docs`` documents of the language.

    One exchange by (lang, term) serves both groupings: batches have counted before it, so a frequent term has one row for each
    batch and source.
    """
    counts = term_counts(docs).repartition("lang", "term")
    by_source = counts.groupBy("lang", "term", "source").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    cells = F.collect_list(F.struct("source", "c")).alias("cells")
    return by_source.groupBy("lang", "term").agg(F.sum("c").alias("total"), F.sum("d").alias("_d"), cells).where(F.col("_d") >= min_docs).drop("_d")


def share(counts: np.ndarray, of: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 2) / of), exactly."""
    out = np.empty(len(counts), np.int64)
    wide = counts > _NARROW
    if of >= 1 << 63:
        wide[:] = True
    out[~wide] = 1 + (UNIT * (counts[~wide] + 2)) // (of if of < 1 << 63 else 1)
    for i in np.flatnonzero(wide).tolist():
        out[i] = 1 + UNIT * (int(counts[i]) + 2) // of
    return out


def _pair_sums(terms: DataFrame, sources: dict[str, dict[str, int]]) -> DataFrame:
    """Partial sums of the divergences of all pairs of sources: lang, a, b (numbers of sources) and value.

    ``sources`` has for each language N + 2 V of every source, in the order of the numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, cells = single(batch.column("lang")).dictionary_encode(), single(batch.column("cells"))
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                names, of = list(sources[lang]), list(sources[lang].values())
                place = pa.array(names, pa.string())
                mine = cells.take(pa.array(np.flatnonzero(np.asarray(langs.indices) == code)))
                total = sums.setdefault(lang, np.zeros((len(names), len(names)), np.int64))
                none = np.array([share(np.zeros(1, np.int64), n)[0] for n in of])
                step = max(1, CELLS // len(names))
                for at in range(0, len(mine), step):
                    part = mine[at : at + step]
                    flat = part.flatten()
                    row = np.repeat(np.arange(len(part)), np.diff(np.asarray(part.offsets)))
                    source = np.asarray(pa.compute.index_in(flat.field("source"), value_set=place)).astype(np.int64)
                    count = np.asarray(flat.field("c"))
                    p = np.repeat(none[:, None], len(part), axis=1)
                    for s in np.unique(source).tolist():
                        own = source == s
                        p[s, row[own]] = share(count[own], of[s])
                    for s in range(len(names)):
                        gap = p - p[s]
                        total[s] += (gap * gap // (p + p[s])).sum(axis=1)
        for lang, total in sums.items():
            a, b = np.nonzero(~np.eye(len(total), dtype=bool))
            columns = [pa.array([lang] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(total[a, b])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "value"])

    return terms.select("lang", "cells").mapInArrow(run, "lang string, a long, b long, value long")


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int | None = TOP) -> DataFrame:
    """Compare the sources of every language, and every source with its language, by the shares of their terms.

    A language keeps the V terms in at least ``min_docs`` of its documents. A count c of N gives the share p = 1 + floor(10^9 (c + 2) / (N
    + 2 V)); two shares diverge by floor((p - q)^2 / (p + q)). Returns lang, source, part, item, value and rank: part ``pair`` has
    every other source of the language with the sum over all kept terms (0 without terms), part ``term`` the terms that
    the source has more than its language, at most ``top`` (None: all). Ranks go by value descending, then item in byte order.

    Null text, lang and source read as empty; sources without documents with terms are compared too. Repeated rows are documents of
    their own; nothing depends on doc_id, and other columns are ignored. A text or a term may have any length.
    A source that is alone in its language has no pairs. An empty table gives an empty result. The result has a row for every pair of
    sources; the driver holds the names and sizes of the sources, one row for each.
    """
    prepare_tasks(docs.sparkSession)
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), text_or_empty().alias("text"))
    terms = saved(kept_terms(texts, min_docs), "divergence-terms")
    cells = terms.select("lang", "term", "total", F.explode("cells").alias("cell")).select("lang", "term", "total", "cell.source", "cell.c")
    sizes = cells.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    groups = texts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "n_lang")))
    # Ordered, so that every language's sources have the same numbers in a rerun.
    groups = saved(groups.orderBy("lang", "source"), "divergence-groups")
    sources: dict[str, dict[str, int]] = {}
    for row in groups.orderBy("lang", "source").toArrow().to_pylist():
        sources.setdefault(row["lang"], {})[row["source"]] = row["n"] + 2 * row["v"]
    sums = _pair_sums(terms, sources).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    numbered = groups.withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
    left = numbered.select("lang", "source", F.col("i").alias("a"))
    right = numbered.select("lang", F.col("source").alias("item"), F.col("i").alias("b"))
    pairs = left.join(right, "lang").where(F.col("a") != F.col("b")).join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    def exact(count: str, n: str):
        above = F.lit(UNIT).cast("decimal(10,0)") * (F.col(count) + 2).cast("decimal(20,0)")
        below = (F.col(n) + 2 * F.col("v")).cast("decimal(20,0)")
        return above, below

    found = cells.join(groups, ["lang", "source"])
    for name, count, n in (("p", "c", "n"), ("q", "total", "n_lang")):
        above, below = exact(count, n)
        found = found.withColumns({f"_{name}a": above, f"_{name}b": below}).withColumn(name, F.expr(f"1 + (_{name}a div _{name}b)"))
    found = found.where(F.col("p") > F.col("q"))
    value = F.expr("((p - q) * (p - q)) div (p + q)")
    found = found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int"))

    found = ranked(found)
    return ranked(pairs).unionByName(found if top is None else found.where(F.col("rank") <= top))
