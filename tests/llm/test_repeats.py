"""Word and byte spans that repeat earlier, against brute force."""

import hashlib
import re

import numpy as np
import pytest

from tallybasket.llm import debruijn_dedup, repeats, suffix_dedup
from tallybasket.llm.common import Rolling
from tests.llm.conftest import as_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def in_order(spark, rows):
    """Distinct (doc_id, text) in the operators' order: id, null last, then the hash of id and text."""
    df = repeats.documents(as_table(spark, rows)).select("ord", "rk", "doc_id", "text").distinct()
    return sorted((r["ord"], r["rk"], r["doc_id"], r["text"]) for r in df.collect())


def brute(units, length, seen):
    gone = [False] * len(units)
    for i in range(len(units) - length + 1):
        window = tuple(units[i : i + length])
        if window in seen:
            gone[i : i + length] = [True] * length
        seen.add(window)
    return gone


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_words(spark, docs, rows):
    seen, want = set(), {}
    for _, _, doc_id, text in in_order(spark, rows):
        words = WORD.findall(text)
        gone = brute(words, 20, seen)
        want[doc_id, text] = (len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g).encode()))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in debruijn_dedup.remove_repeats(docs).collect())
    assert got == sorted((str(i), *want[i, t or ""]) for i, t, _, _ in rows)
    assert sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("length,group_strings", [(100, 1000), (40, 0), (40, 3)])
def test_bytes(spark, docs, rows, length, group_strings, monkeypatch):
    """With every group split, some split, and none: the same result."""
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (length, 24, group_strings))
    monkeypatch.setattr(suffix_dedup, "SORT_WINDOWS", 500)
    seen, want = set(), {}
    for _, _, doc_id, text in in_order(spark, rows):
        raw = text.encode()
        gone = np.array(brute(raw, length, seen), dtype=np.int8)
        runs = int((np.diff(np.r_[0, gone]) == 1).sum())
        want[doc_id, text] = (len(raw), int(gone.sum()), runs, sha(np.frombuffer(raw, np.uint8)[gone == 0].tobytes()))
    out = suffix_dedup.remove_repeats(docs, length).collect()
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)
    assert got == sorted((str(i), *want[i, t or ""]) for i, t, _, _ in rows)
    for r in out:
        assert sum(x["end"] - x["start"] for x in r["removed"]) == r["n_removed"] and len(r["removed"]) == r["n_spans"]


def test_kept_text_is_text_even_if_a_character_is_cut(spark):
    """Two characters that differ in their first byte only: the second byte is part of the match."""
    shared = "".join(chr(0x180 + i) for i in range(59))
    table = as_table(spark, [(1, "\u0141" + shared, "en", "s"), (2, "ab\u0101" + shared + "ü", "en", "s"), (3, None, "en", "s")])
    out = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(table, 101).collect()}
    assert out[1]["kept_text"] == "\u0141" + shared
    assert out[2]["n_removed"] == 119 and out[2]["kept_text"] == "abü"
    assert out[3]["was_null"] and out[3]["kept_text"] == ""


def test_no_rows(spark, no_docs):
    assert debruijn_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_a_common_passage_makes_one_row_of_its_string(spark):
    """Copies of strings collapse before they meet: first occurrences do not grow with the copies."""
    passage = " ".join(f"w{i}" for i in range(80))
    few = as_table(spark, [(i, f"a{i} {passage} z{i}", "en", "s") for i in range(5)])
    many = as_table(spark, [(i, f"a{i} {passage} z{i}", "en", "s") for i in range(200)])
    counts = []
    for table in (few, many):
        near, first = repeats.candidates(repeats.documents(table), debruijn_dedup._units, 20, 8, "t")
        counts.append((near.count(), first.count()))
    assert counts[1][0] > 20 * counts[0][0] and counts[1][1] <= counts[0][1] + 2 * 200


@pytest.mark.parametrize("module,find,tables", [
    (debruijn_dedup, "verified_spans", ["debruijn-edges", "debruijn-spans"]), (suffix_dedup, "repeated_spans", ["suffix-bodies", "suffix-later"]),
])
def test_a_row_repeated_in_full_is_looked_at_once(spark, module, find, tables, monkeypatch):
    """Rows that agree in id and text give the bodies, edges and span entries of one."""
    counts = {}

    def counted(df, name, save=module.saved):
        out = save(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(module, "saved", counted)
    passage = " ".join(f"w{i}" for i in range(60))
    other = [(1, f"a {passage} b", "en", "s"), (3, f"{passage[:200]} {passage[100:]}", "en", "s")]
    seen = []
    for times in (1, 40):
        row = (2, f"c {passage} d {passage} {passage[50:]}", "en", "s")
        spans = getattr(module, find)(repeats.documents(as_table(spark, other + [row] * times)))
        entries = {r["rk"]: len(r["spans"]) for r in spans.collect()}
        seen.append((entries, [counts[t] for t in tables]))
    assert seen[0] == seen[1] and len(seen[0][0]) == 2 and min(seen[0][1]) > 0


def test_shares_hold_part_of_the_strings_and_change_nothing(spark, docs, monkeypatch):
    """No table of strings holds all of them, and all shares together find what one finds."""
    rows = lambda: sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()), key=repr)
    sizes, write = [], repeats.saved

    def counted(df, name):
        table = write(df, name)
        if name == "suffix-strings":
            sizes.append(table.count())
        return table

    monkeypatch.setattr(repeats, "saved", counted)
    want = rows()
    assert max(sizes) < sum(sizes) / 2
    monkeypatch.setattr(suffix_dedup, "SHARES", 1)
    assert rows() == want
    assert sizes[-1] == sum(sizes[:-1])


def test_a_false_source_removes_nothing(spark, monkeypatch):
    """The words at the source's coordinates are compared: hashes that collide do not remove text."""
    text = [" ".join(f"{p}{i}" for i in range(30)) for p in "ab"]
    rows = repeats.documents(as_table(spark, [(1, text[0], "en", "s"), (2, text[1], "en", "s")]))
    ids = {r["doc_id"]: r["rk"] for r in rows.select("doc_id", "rk").collect()}
    raw = debruijn_dedup._Words(text[0].encode()).digest(0, 30)
    spans = spark.createDataFrame([(ids[2], [(0, 11, raw)])], "rk long, spans array<struct<pos:long,n:int,sha:binary>>")
    monkeypatch.setattr(debruijn_dedup, "verified_spans", lambda *a: spans)
    out = {r["doc_id"]: r["n_removed"] for r in debruijn_dedup.remove_repeats(as_table(spark, [(1, text[0], "en", "s"), (2, text[1], "en", "s")])).collect()}
    assert out == {1: 0, 2: 0}


def test_rolling_hash_depends_on_content_only():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 4, 500).astype(np.uint64)
    hashes = Rolling(values).windows(5)
    seen = {}
    for i, h in enumerate(hashes.tolist()):
        assert seen.setdefault(tuple(values[i : i + 5]), h) == h
    assert len(set(seen.values())) == len(seen)
