import hashlib
import random

import pytest
from tokenizers import Tokenizer

from tallybasket.llm import bpe
from tallybasket.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_table_against_the_library(docs, rows, library):
    want = []
    for doc_id, text, _, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((str(doc_id), len(ids), ids, sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    out = bpe.encode_texts(docs, vocabulary()).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids"], r["ids_sha256"], r["decoded_sha256"]) for r in out) == sorted(want)


def test_random_texts_against_the_library(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 200)
    machine = bpe.automaton(vocabulary())
    chunks, rng = bpe.Chunks(machine), random.Random(4)
    alphabets = ["ab", "hello wrdtin", "aA1 .\n\t'sé", "   \x1c\x1f\x85\n a", "ñçß日本語😀 ", "===---   ##\n\n", "'s 't 'LL'll x", "0123456789 "]
    texts = ["".join(rng.choice(alphabets[i % 8]) for _ in range(rng.randint(0, 50))) for i in range(3000)]
    for text in [*texts, "a" * 3000, " " * 1000, "<|endoftext|>", "x <|endoftext|>\n y", "<|endoftext"]:
        line = chunks.encode(text)
        ids = list(map(int, line.split(","))) if line else []
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert bpe.decode(machine, ids) == text


def test_automaton_of_a_few_merges(tmp_path):
    """Against plain application of the merges in order, over all words of two letters."""
    import itertools
    import json

    merges = [("a", "b"), ("b", "b"), ("a", "a"), ("aa", "b"), ("ab", "ab"), ("bb", "a")]
    vocab = {t: i for i, t in enumerate(["a", "b", *("".join(m) for m in merges)])}
    path = tmp_path / "small.json"
    path.write_text(json.dumps({"model": {"vocab": vocab, "merges": [list(m) for m in merges]}}))
    machine = bpe.Automaton(str(path))
    assert len(machine.copied) <= 1 + len(merges)
    for n in range(1, 11):
        for word in itertools.product("ab", repeat=n):
            parts = list(word)
            for a, b in merges:
                i, out = 0, []
                while i < len(parts):
                    if parts[i : i + 2] == [a, b]:
                        out.append(a + b)
                        i += 2
                    else:
                        out.append(parts[i])
                        i += 1
                parts = out
            assert machine.encode_word("".join(word).encode()) == [vocab[p] for p in parts], word


def test_no_rows(no_docs):
    assert bpe.encode_texts(no_docs, vocabulary(), keep_ids=False).count() == 0
