"""Frequent phrases and their association, by fingerprints of n-grams.

Texts are lower-cased (A-Z) and cut into pieces, pieces into words. Prefix polynomials over a batch's bytes give
the Rabin-Karp hash of every word, and prefix polynomials over these hashes give a 64-bit *fingerprint* of every
n-gram, language included, without looking at its bytes again.

1. Fingerprints of words are counted in each batch, and the shuffle adds the counts up.
2. So are those of pairs whose words are both frequent, and of longer n-grams whose pairs all are. A task knows
   frequent fingerprints by one bit each in a bitmap of fixed size; foreign bits that are set cost work, never results.
3. Frequent fingerprints are met once more in the texts. Every batch has for each a pointer to one occurrence and compares the words of
   all others with it; those that differ (collisions) are told apart. Only these phrases become strings, one for
   each batch, and their counts are added up by text, so that the final counts are exact whatever collides.

Pointers do not leave the batch: a phrase of five words takes hardly more bytes than a pointer to it.
Scores are decimals of 38 digits throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybasket.llm.common import STEP_BYTES, Rolling, byte_values, bytes_of, discard, mixed, prepare_tasks, saved, single, steps, text_or_empty

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
UNKNOWN = "und"
#: Bits of the bitmap of frequent fingerprints: 16 MB for every Python worker, the same at every size.
FILTER_BITS = 1 << 27
#: Different n-grams that a task holds before it hands them on.
HELD = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True


class Words:
    """The words of some texts: spans in ``data``, piece (numbered over all texts), text and hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, lang_hashes: np.ndarray):
        self.data = _LOWER[data]
        gap = _GAP[self.data]
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        before = np.r_[True, gap[:-1]] | begins[:-1]
        after = np.r_[gap[1:], True] | begins[1:]
        self.starts = np.flatnonzero(~gap & before)
        self.ends = np.flatnonzero(~gap & after) + 1
        self.text = np.searchsorted(offsets, self.starts, side="right") - 1
        breaks = np.cumsum(_BREAK[self.data], dtype=np.int64)
        # Texts are pieces of their own: the number of a text is added to that of the breaks before the word.
        self.piece = breaks[self.starts] + self.text
        self.lang = langs[self.text]
        self.hashes = Rolling(byte_values(self.data)).spans(self.starts, self.ends)
        self.rolling = Rolling(self.hashes)
        self.lang_hash = lang_hashes[self.lang]

    def grams(self, n: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of the n-grams from every word that has n - 1 more behind it, and whether they are of one piece."""
        windows = self.rolling.windows(n)
        size = len(windows)
        with np.errstate(over="ignore"):
            found = mixed(windows ^ (self.lang_hash[:size] + np.uint64(n) * np.uint64(0x9E3779B97F4A7C15)))
        return found >> np.uint64(64 - bits), self.piece[:size] == self.piece[n - 1 :]


def hits(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    at = prints & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def bitmap_of(frequent: list[DataFrame], bits: int) -> np.ndarray:
    """One bit for each ``fp``; the driver gets at most ``bits`` / 64 words of it."""
    prints = frequent[0].select("fp")
    for other in frequent[1:]:
        prints = prints.unionByName(other.select("fp"))
    at = F.col("fp").bitwiseAND(bits - 1)
    one = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = prints.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[np.asarray(words["word"])] = np.asarray(words["bits"]).astype(np.int64).view(np.uint64)
    return bitmap


def _cut(texts: pa.Array, langs: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]]:
    """Steps of about ``STEP_BYTES``: bytes, offsets, language of each text, all languages of the step and their hashes.

    Pieces are independent, so a longer text is cut between pieces, at the first break of each step's length.
    """
    for a, b in steps(texts, STEP_BYTES):
        codes = langs[a:b].dictionary_encode()
        names = codes.dictionary.to_pylist()
        data, offsets = bytes_of(pa.array(names, pa.string()))
        hashes = Rolling(byte_values(data)).spans(offsets[:-1], offsets[1:])
        data, offsets = bytes_of(texts[a:b])
        code = np.asarray(codes.indices).astype(np.int64)
        if len(data) <= 2 * STEP_BYTES:
            yield data, offsets, code, names, hashes
            continue
        # A step beyond that length is one text.
        breaks, start = np.flatnonzero(_BREAK[data]), 0
        while start < len(data):
            at = int(np.searchsorted(breaks, start + STEP_BYTES))
            stop = int(breaks[at]) + 1 if at < len(breaks) else len(data)
            yield data[start:stop], np.array([0, stop - start]), code, names, hashes
            start = stop


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text_or_empty().alias("text"))


class _Sums:
    """Counts of fingerprints, held until there are ``HELD`` different ones."""

    def __init__(self):
        self.prints, self.counts, self.size = [], [], 0

    def add(self, prints: np.ndarray) -> None:
        found, counts = np.unique(prints, return_counts=True)
        self.prints.append(found)
        self.counts.append(counts)
        self.size += len(found)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate(self.prints) if self.prints else np.zeros(0, np.uint64)
        found, inverse = np.unique(every, return_inverse=True)
        counts = np.bincount(inverse, np.concatenate(self.counts), len(found)).astype(np.int64) if len(found) else np.zeros(0, np.int64)
        self.prints, self.counts, self.size = [found], [counts], len(found)
        return found, counts


def _print_rows(prints: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(prints), pa.string())
    return pa.RecordBatch.from_arrays([none, pa.array(prints.view(np.int64)), pa.array(counts)], names=["lang", "fp", "c"])


def fingerprints(docs: DataFrame, lengths: list[int], known: np.ndarray | None, bits: int = 64) -> DataFrame:
    """Counts of fingerprints of n-grams of the given lengths, pre-aggregated: fp, c, and null ``lang``.

    With lengths from 2 on, ``known`` is the bitmap of frequent words (lengths [2]) or of frequent pairs. With length 1, rows
    with a ``lang`` and a null fp count all words of a language.
    """
    wide = known is not None and lengths != [2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, totals = _Sums(), {}
        for batch in batches:
            for data, offsets, code, names, hashes in _cut(single(batch.column("text")), single(batch.column("lang"))):
                words = Words(data, offsets, code, hashes)
                if 1 in lengths:
                    for name, n in zip(names, np.bincount(words.lang, minlength=len(names)).tolist()):
                        totals[name] = totals.get(name, 0) + n
                part = None
                if known is not None:
                    prints, valid = words.grams(2 if wide else 1, bits)
                    part = valid & hits(known, prints)
                alive = part
                for n in range(1 if known is None else 3 if wide else 2, max(lengths) + 1):
                    prints, valid = words.grams(n, bits)
                    if part is not None:
                        # Frequent so far, and the last word (or pair) of the n-gram is frequent too.
                        alive = alive[: len(prints)] & part[len(part) - len(prints) :] & valid
                        valid = alive
                    if n in lengths:
                        sums.add(prints[valid])
            if sums.size > HELD and len(sums.merged()[0]) > HELD // 2:
                yield _print_rows(*sums.merged())
                sums = _Sums()
        yield _print_rows(*sums.merged())
        if totals:
            columns = [pa.array(list(totals), pa.string()), pa.nulls(len(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "fp", "c"])

    return docs.mapInArrow(run, "lang string, fp long, c long")


def exact_words(words: Words, chosen: np.ndarray) -> np.ndarray:
    """A number for each chosen word (-1 for others), equal exactly for equal bytes; hashes only propose."""
    ids = np.full(len(words.starts), -1, np.int64)
    at = np.flatnonzero(chosen)
    _, first, inverse = np.unique(words.hashes[at], return_index=True, return_inverse=True)
    ids[at] = inverse
    lengths, model = words.ends[at] - words.starts[at], first[inverse]
    same = lengths == lengths[model]
    for size in np.unique(lengths[same]).tolist():
        rows = np.flatnonzero(same & (lengths == size))
        span = np.arange(size)
        for a in range(0, len(rows), max(1, STEP_BYTES // size)):
            part = rows[a : a + max(1, STEP_BYTES // size)]
            mine, other = (words.data[words.starts[at[i]][:, None] + span] for i in (part, model[part]))
            same[part] = (mine == other).all(axis=1)
    odd: dict[bytes, int] = {}
    for i in at[~same].tolist():
        ids[i] = odd.setdefault(words.data[words.starts[i] : words.ends[i]].tobytes(), len(first) + len(odd))
    return ids


def verified(words: Words, ids: np.ndarray, rows: np.ndarray, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pointers (first word) to one occurrence of every different n-gram at ``rows``, and their counts.

    Occurrences of one fingerprint are compared word for word with the first; others are told apart.
    """
    _, first, inverse = np.unique(prints[rows], return_index=True, return_inverse=True)
    model = rows[first][inverse]
    same = words.lang[rows] == words.lang[model]
    for j in range(n):
        same &= ids[rows + j] == ids[model + j]
    counts = np.bincount(inverse[same], minlength=len(first))
    odd: dict[tuple[int, ...], list[int]] = {}
    for i in rows[~same].tolist():
        odd.setdefault((int(words.lang[i]), *ids[i : i + n].tolist()), [i, 0])[1] += 1
    more = np.array(list(odd.values()), np.int64).reshape(-1, 2)
    return np.r_[rows[first], more[:, 0]], np.r_[counts, more[:, 1]]


def phrases(docs: DataFrame, known: np.ndarray, max_words: int, bits: int = 64) -> DataFrame:
    """lang, n, phrase and count of n-grams whose fingerprint is in ``known``, one row for each step they stand in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, offsets, code, names, hashes in _cut(single(batch.column("text")), single(batch.column("lang"))):
                words = Words(data, offsets, code, hashes)
                found = []
                for n in range(1, max_words + 1):
                    prints, valid = words.grams(n, bits)
                    found.append((np.flatnonzero(valid & hits(known, prints)), prints))
                chosen = np.zeros(len(words.starts), bool)
                for n, (rows, _) in enumerate(found, 1):
                    for j in range(n):
                        chosen[rows + j] = True
                ids = exact_words(words, chosen)
                raw = words.data.tobytes()
                begin, end = words.starts.tolist(), words.ends.tolist()
                for n, (rows, prints) in enumerate(found, 1):
                    heads, counts = verified(words, ids, rows, prints, n)
                    out = [b" ".join(raw[begin[j] : end[j]] for j in range(i, i + n)) for i in heads.tolist()]
                    columns = [pa.array([names[k] for k in words.lang[heads].tolist()], pa.string()), pa.array(np.full(len(heads), n, np.int32))]
                    columns += [pa.array(out, pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "phrase", "a"])

    return docs.mapInArrow(run, "lang string, n int, phrase string, a long")


def _frequent(counts: DataFrame, least: int, name: str) -> DataFrame:
    summed = counts.where(F.col("fp").isNotNull()).groupBy("fp").agg(F.sum("c").alias("c"))
    return saved(summed.where(F.col("c") >= least).select("fp"), name)


def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, filter_bits: int = FILTER_BITS, bits: int = 64
) -> tuple[DataFrame, DataFrame]:
    """Written tables: every phrase of 1 to ``max_words`` words with at least ``min_count`` occurrences (lang, n, phrase, a), and
    all words of each language (lang, total). ``bits`` shortens fingerprints, for tests of collisions."""
    prepare_tasks(docs.sparkSession)
    texts = _texts(docs)
    words = saved(fingerprints(texts, [1], None, bits), "phrases-words")
    totals = saved(words.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.sum("c").alias("total")), "phrases-totals")
    levels = [_frequent(words, min_count, "phrases-1")]
    discard(words)
    if max_words > 1:
        levels.append(_frequent(fingerprints(texts, [2], bitmap_of(levels, filter_bits), bits), min_count, "phrases-2"))
    if max_words > 2:
        longer = fingerprints(texts, list(range(3, max_words + 1)), bitmap_of(levels[1:], filter_bits), bits)
        levels.append(_frequent(longer, min_count, "phrases-3"))
    met = phrases(texts, bitmap_of(levels, filter_bits), max_words, bits)
    counted = met.groupBy("lang", "n", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)
    counted = saved(counted, "phrases-counted")
    discard(*levels)
    return counted, totals


def _exact(column: str, digits: int = 19):
    return F.col(column).cast(f"decimal({digits},0)")


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int | None = TOP, covered_percent: int = 100, **settings
) -> DataFrame:
    """Phrases of 2 to ``max_words`` words that stand together more than their parts explain, ranked within each language.

    Returns lang (null: ``und``), rank (from 1), phrase (words joined by one space), a (all occurrences, overlaps included), l and r
    (those of both sides of the weakest cut), n (words of the language) and score, floor(1000 a n / (l r)) of that cut, of
    equal ones the one after the fewest words. A phrase that lies in a longer frequent one with at least ``covered_percent`` of its
    occurrences is dropped. Ranks go by score, a (both descending) and phrase in byte order; ``top`` ends the list, None keeps all.

    Null texts count as empty. Repeated rows count each time. Nothing depends on doc_id, and other columns are ignored. A text of any length is
    taken whole, cut between pieces. An empty table, or one without frequent phrases, gives an empty result.
    """
    counted, totals = frequent_phrases(docs, min_count, max_words, **settings)
    words = F.split("phrase", " ", -1)
    longer = counted.where(F.col("n") > 1).withColumn("w", words)
    cuts = longer.select("lang", "phrase", "a", "w", F.size("w").alias("size"), F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    lefts = counted.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    rights = counted.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    measured = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).join(totals, "lang")
    # 1000 a n has at most 38 digits, as l r: counts stay below 10^19 and a below 10^16.
    above = F.lit(1000).cast("decimal(4,0)") * (_exact("a", 16) * _exact("total", 18))
    product = (_exact("l") * _exact("r")).alias("lr")
    scored = measured.select("lang", "phrase", "a", "k", "l", "r", "total", above.cast("decimal(38,0)").alias("above"), product)
    scored = scored.withColumn("score", F.expr("above div lr"))
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("total").alias("n"), weakest)
    # Parts of longer phrases, of two words and more, with the most occurrences of a phrase around them.
    inner = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), s -> transform(sequence(1, size(w) - s + 1), i -> array_join(slice(w, i, s), ' '))))"
    )
    around = longer.where(F.col("n") > 2).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = best.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.lit(100) * F.col("around") < F.lit(covered_percent) * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
