"""Statistics of whole texts, counted over the bytes of many texts at once.

One row per text with the columns of ``COLUMNS``. Words are those of ``common.WORD``; lines are split at
``\\n``; a line counts as repeated if it holds a word and equals an earlier line of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybasket.llm.common import Rolling, byte_values, bytes_of, is_space, mixed, prepare_tasks, single, steps, words_of

COLUMNS = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_digits", "n_punctuation",
    "n_wide", "n_caps_words", "n_symbol_words", "n_stop_words", "n_lower_start", "n_distinct_words", "n_pipes", "n_exclamations",
    "n_long_words", "longest_word",
]
#: Characters that count as symbols (fixed values).
SYMBOLS = b"#*$%&|<>"
#: Common words of the languages in view; only their share is used.
STOP_WORDS = (
    "the of and to in is that it for on with as was at by be this are from or an a not have but "
    "de la le les et des en un une du que qui dans pour pas sur au avec est par se ne "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "el los las y del una con por para su al lo como más o pero sus"
).split()


def _flag(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_SYMBOL = _flag(SYMBOLS)
_PUNCTUATION = _flag(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_UPPER, _LOWER, _DIGIT = _flag(bytes(range(65, 91))), _flag(bytes(range(97, 123))), _flag(bytes(range(48, 58)))


def _hash_of(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return Rolling(byte_values(data)).spans(np.array([0]), np.array([len(data)]))[0]


def repeated(owner: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (owner, key) pairs: whether the pair is met twice or more, and whether it is not the first of its kind."""
    joint = mixed(keys + mixed(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(joint, kind="stable")
    ordered = joint[order]
    same = np.zeros(len(joint) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    twice, later = np.zeros(len(joint), bool), np.zeros(len(joint), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def _per(owner: np.ndarray, flags: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner[flags], minlength=n)


def statistics_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """Columns of ``COLUMNS`` as int64 arrays; ``texts`` has no nulls."""
    out = {c: np.zeros(len(texts), np.int64) for c in COLUMNS}
    stop = np.sort(np.array([_hash_of(w) for w in STOP_WORDS], np.uint64))
    for a, b in steps(texts):
        data, offsets = bytes_of(texts[a:b])
        n = b - a
        if not len(data):
            continue
        sums = lambda flags: np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][offsets])
        solid = ~is_space(data)
        starts, ends, first = words_of(data, offsets)
        owner = np.repeat(np.arange(n), np.diff(first))
        put = lambda name, values: out[name].__setitem__(slice(a, b), values)
        put("n_words", np.diff(first))
        put("word_chars", sums(solid & ((data & 0xC0) != 0x80)))
        for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_lower", _LOWER), ("n_digits", _DIGIT), ("n_punctuation", _PUNCTUATION)):
            put(name, sums(table[data]))
        put("n_wide", sums(data >= 0xC0))
        put("n_pipes", sums(data == 124))
        put("n_exclamations", sums(data == 33))
        rolling = Rolling(byte_values(data))
        if len(starts):
            hashes = rolling.spans(starts, ends)
            symbol_sums = np.r_[0, np.cumsum(_SYMBOL[data] | (data == 33), dtype=np.int64)]
            upper_sums = np.r_[0, np.cumsum(_UPPER[data], dtype=np.int64)]
            lower_sums = np.r_[0, np.cumsum(_LOWER[data], dtype=np.int64)]
            put("n_symbol_words", _per(owner, symbol_sums[ends] > symbol_sums[starts], n))
            put("n_caps_words", _per(owner, (upper_sums[ends] > upper_sums[starts]) & (lower_sums[ends] == lower_sums[starts]), n))
            put("n_stop_words", _per(owner, stop[np.minimum(np.searchsorted(stop, hashes), len(stop) - 1)] == hashes, n))
            put("n_lower_start", _per(owner, _LOWER[data[starts]], n))
            put("n_long_words", _per(owner, ends - starts > 24, n))
            np.maximum.at(out["longest_word"], a + owner, ends - starts)
            put("n_distinct_words", _per(owner, ~repeated(owner, hashes)[1], n))
            if len(starts) > 2:
                windows = Rolling(hashes).windows(3)
                whole = owner[2:] == owner[:-2]
                twice = np.zeros(len(windows), bool)
                twice[whole] = repeated(owner[:-2][whole], windows[whole])[0]
                covered = np.zeros(len(starts), bool)
                for shift in range(3):
                    covered[shift : shift + len(twice)] |= twice
                put("n_repeat_words", _per(owner, covered, n))
        # Lines: every text has one more than it has newlines.
        breaks = np.flatnonzero(data == 10)
        line_starts = np.sort(np.r_[offsets[:-1], breaks + 1])
        line_owner = np.repeat(np.arange(n), sums(data == 10) + 1)
        line_ends = np.r_[line_starts[1:], offsets[-1] + 1] - 1
        # The last line of a text ends where the text ends, the others before their newline.
        last = np.r_[line_owner[1:] != line_owner[:-1], True]
        line_ends[last] = offsets[1:]
        solid_sums = np.r_[0, np.cumsum(solid, dtype=np.int64)]
        full = solid_sums[line_ends] > solid_sums[line_starts]
        later = np.zeros(len(line_starts), bool)
        later[full] = repeated(line_owner[full], rolling.spans(line_starts[full], line_ends[full]))[1]
        put("n_lines", np.diff(np.searchsorted(line_owner, np.arange(n + 1))))
        put("n_dup_lines", _per(line_owner, later, n))
    return out


def with_statistics(rows: DataFrame) -> DataFrame:
    """Replace column ``text`` (no nulls) of ``rows`` by the columns of ``COLUMNS`` (long)."""
    prepare_tasks(rows.sparkSession)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in kept] + COLUMNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics_of(single(batch.column("text")))
            columns = [batch.column(f) for f in names[: len(names) - len(COLUMNS)]]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(found[c]) for c in COLUMNS)], names=names)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{c} long" for c in COLUMNS])
    return rows.mapInArrow(run, schema)
