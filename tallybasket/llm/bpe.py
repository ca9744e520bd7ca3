"""Byte-level BPE by a deterministic tokenization automaton.

**Automaton.** It accepts exactly the token sequences that BPE can produce. It starts with one state and
one loop per byte. Merges are added in order of priority. The gadget of merge (a, b): the state q that all
a-arcs enter is copied without its b-arc, the a-arcs are led to the copy, and beside every a-arc an
ab-arc runs to where q's b-arc went. All arcs of one token enter one state, so a state is known by the
last token, every merge adds one state, and a state needs three numbers: the state it was copied from, the
arc it lost, and the merge that made it. Arc t of state p, if t is newer than p, exists if p has the arc of
t's left part (the gadget ran beside it); otherwise if the state that p copied has it and it is not the
lost one. These transitions fill a table as they are met.

**Encoding.** Texts are split like the vocabulary's own pre-tokenizer, words are run through the
automaton: for every prefix exactly one path of arcs spells it, and its last arc is found among the
tokens that end there. **Decoding** emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybasket.llm.common import prepare_tasks, single, text_or_empty

#: Unicode white space, as the vocabulary's pattern means it (fixed values).
SPACE = r"\t-\r \x85\xa0  -     　"
#: The pre-tokenizer's published pattern (fixed value), with its white space written out.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|[%s]+(?![^%s])|[%s]+" % ((SPACE,) * 4)
)
#: A run of white space with the solid run after it: no token crosses its ends.
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Words and chunks whose tokens a task remembers in each of two generations; the older one is dropped.
REMEMBERED = 250_000
#: Transitions that a task's table keeps; it starts anew beyond that.
TABLE_ENTRIES = 1_000_000
NO_TOKEN = -1


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Tables built from a vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        of_char, model = byte_characters(), spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        size = max([*vocab.values(), *self.special.values()], default=0) + 1
        self.labels: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if token not in self.special:
                self.labels[i] = bytes(of_char[c] for c in token)
        for token, i in self.special.items():
            self.labels[i] = token.encode()
        self.made = [0] * size  # the merge that made the token's arcs; 0 for bytes
        self.left = [NO_TOKEN] * size
        self.target = [0] * size  # state that the token's arcs enter
        self.copied, self.lost, self.born = [0], [NO_TOKEN], [0]  # of each state
        self.table: dict[int, bool] = {}
        by_label = {}
        for token, i in vocab.items():
            if len(token) == 1 and token in of_char:
                by_label[self.labels[i]] = i
        for n, merge in enumerate(model["merges"], start=1):
            a, b = (vocab[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            ab = vocab[self._joined(merge)]
            if self.labels[ab] in by_label or not self.has_arc(self.target[a], b):
                continue  # the parts never meet, or the token exists already
            by_label[self.labels[ab]] = ab
            self.made[ab], self.left[ab] = n, a
            # With a = b the token goes where the second a went before the copy.
            self.target[ab] = self.target[b]
            self.copied.append(self.target[a])
            self.lost.append(b)
            self.born.append(n)
            self.target[a] = len(self.copied) - 1
        self.table.clear()  # entries met while the automaton grew stay true, but are many
        self.by_label = by_label
        self.reach: dict[bytes, int] = {}  # three bytes to the length of the longest token that begins with them
        for label in by_label:
            self.reach[label[:3]] = max(self.reach.get(label[:3], 3), len(label))
        pattern = "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True))
        self.special_split = re.compile(f"({pattern})") if pattern else None

    @staticmethod
    def _joined(merge) -> str:
        return merge.replace(" ", "", 1) if isinstance(merge, str) else "".join(merge)

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the state has an arc of the token."""
        key = state << 32 | token
        known = self.table.get(key)
        if known is not None:
            return known
        made, born, copied, lost, left = self.made, self.born, self.copied, self.lost, self.left
        p, t = state, token
        while True:
            if made[t] and made[t] >= born[p]:
                t = left[t]
            elif p == 0:
                found = True
                break
            elif t == lost[p]:
                found = False
                break
            else:
                p = copied[p]
        if len(self.table) >= TABLE_ENTRIES:
            self.table.clear()
        self.table[key] = found
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """Tokens of one pre-split word: the automaton's only path that spells it.

        The longest token that the current state has an arc for is tried first. A prefix of the word is
        spelt by one path only, so a position from which no arc goes on is dead for good.
        """
        n, by_label, labels, target, has_arc = len(word), self.by_label, self.labels, self.target, self.has_arc
        reach = self.reach
        path: list[int] = []
        state, at, end = 0, 0, min(n, reach.get(word[:3], 3))
        dead = set()
        while at < n:
            while end > at:
                token = by_label.get(word[at:end])
                if token is not None and end not in dead and has_arc(state, token):
                    break
                end -= 1
            else:
                if not path:
                    raise ValueError("the vocabulary lacks a byte")
                dead.add(at)
                end = at - 1
                at -= len(labels[path.pop()])
                state = target[path[-1]] if path else 0
                continue
            path.append(token)
            state, at = target[token], end
            end = min(n, at + reach.get(word[at : at + 3], 3))
        return path


@lru_cache(maxsize=1)
def _pattern():
    return regex.compile(PATTERN)


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(path)


class Memory(dict):
    """Text to its ids as decimal text, for the texts met of late; what is missing is computed."""

    def __init__(self):
        super().__init__()
        self.older: dict[str, str] = {}

    def __missing__(self, key: str) -> str:
        out = self.older.get(key)
        if out is None:
            out = self.compute(key)
        if len(key) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[key] = out
        return out


class Words(Memory):
    """Pre-split words, which run through the automaton."""

    def __init__(self, machine: Automaton):
        super().__init__()
        self.machine = machine

    def compute(self, word: str) -> str:
        return ",".join(map(str, self.machine.encode_word(word.encode("utf-8"))))


class Chunks(Memory):
    """Runs of white space with the solid run after them, which are split into words."""

    def __init__(self, machine: Automaton):
        super().__init__()
        self.machine, self.words = machine, Words(machine)

    def compute(self, chunk: str) -> str:
        return ",".join(map(self.words.__getitem__, _pattern().findall(chunk)))

    def encode(self, text: str) -> str:
        """All ids of a text, comma-separated; special tokens in the text become their own ids."""
        split = self.machine.special_split
        if split is None or not split.search(text):
            return ",".join(map(self.__getitem__, CHUNK.findall(text)))
        parts = []
        for i, part in enumerate(split.split(text)):
            if i % 2:
                parts.append(str(self.machine.special[part]))
            elif part:
                parts.append(",".join(map(self.__getitem__, CHUNK.findall(part))))
        return ",".join(parts)


def decode(machine: Automaton, ids: list[int]) -> str:
    """Text of the arcs' labels; bytes that are not UTF-8 become U+FFFD."""
    return b"".join(map(machine.labels.__getitem__, ids)).decode("utf-8", errors="replace")


def encode_texts(docs: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """Encode and decode every text with the vocabulary at ``path`` (readable by every task, of fixed size).

    Returns per row: ``doc_id``, ``n_tokens``, ``ids`` (array<int>, if ``keep_ids``), ``ids_sha256`` (of the
    decimal ids joined by commas) and ``decoded_sha256`` (of the text decoded from them). Null texts count as
    empty: no tokens, digests of the empty string. Rows that repeat give repeated rows, null ids stay null, an
    empty table gives an empty result; other columns are ignored. Texts of any length are taken whole.
    """
    schema = "doc_id long, n_tokens long, " + ("ids array<int>, " if keep_ids else "") + "ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        chunks = Chunks(machine)
        for batch in batches:
            counts, digests, decoded, lists = [], [], [], []
            for text in single(batch.column("text")):
                line = chunks.encode(text.as_py())
                ids = list(map(int, line.split(","))) if line else []
                counts.append(len(ids))
                digests.append(hashlib.sha256(line.encode("ascii")).hexdigest())
                decoded.append(hashlib.sha256(decode(machine, ids).encode("utf-8")).hexdigest())
                if keep_ids:
                    lists.append(pa.array(ids, pa.int32()))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64())]
            if keep_ids:
                offsets = [0]
                for part in lists:
                    offsets.append(offsets[-1] + len(part))
                flat = pa.concat_arrays(lists) if lists else pa.array([], pa.int32())
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat))
            columns += [pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    prepare_tasks(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, schema)
