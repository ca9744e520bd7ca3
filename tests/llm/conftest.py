"""A small corpus with every awkward case, and one without rows."""

import random

import pytest

#: Names that the operators use for columns of their own.
CLASHING = ["rk", "ord", "m", "g", "n", "size", "target", "fp", "label", "score", "x", "y", "key", "own", "spans", "stratum", "level", "kept"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def _sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))


def corpus():
    """(doc_id, text, lang, source): nulls, empty and very long texts, copies, overlaps, repeated rows, shared ids."""
    rng = random.Random(5)
    base = [_sentence(rng, rng.randint(1, 150)) for _ in range(25)]
    passage = _sentence(rng, 60)
    rows = [(i, t, rng.choice(["en", "de", None]), f"s{i % 4}") for i, t in enumerate(base)]
    rows += [(100 + i, base[i], "en", "s0") for i in range(6)]
    rows += [(200 + i, base[i] + " x " + passage + "\n" + base[i + 1], "en", "s1") for i in range(8)]
    rows += [(300, "ab " * 400, "en", "s2"), (301, "a" * 700, "en", "s2"), (302, "ab " * 350, "en", "s2")]
    rows += [(303, " ".join(_sentence(rng, 2500) for _ in range(4)) + " " + passage, "de", "s3"), (304, "日本語のテキスト " * 60, "ja", "s9")]
    rows += [(400, None, None, None), (401, "", "en", None), (402, " \t\n\x0b ", "en", "s1"), (403, "\x00\x01 nul", "en", "s1")]
    rows += [(404, "A B\nA B\n\nA B", "en", "s1"), (405, "<|endoftext|> x <|endoftext|>", "en", "s1")]
    rows += [(None, base[2], "en", "s1"), (None, passage, "en", "s1"), (None, None, None, None)]
    rows += [(500, base[3], "en", "s1"), (500, base[3], "en", "s1"), (501, base[4], "en", "s1"), (501, passage, "en", "s1")]
    return rows


def as_table(spark, rows):
    full = [(i, t, la, s, None if t is None else len(t), *["z"] * len(CLASHING)) for i, t, la, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return as_table(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return as_table(spark, [])
