"""The pipeline's stages against plain Python on what the stage before kept."""

import hashlib
import shutil

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallybasket.llm import mixing, quality_model
from tallybasket.llm.common import saved, table
from tallybasket.llm.queries import ORACLES, QUERIES, vocabulary
from tests.llm.test_repeats import brute
from tests.llm.test_simhash import classes, fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = saved(stage(spark, docs, SF), "test-stage")
        out.append((docs, after))
        docs = after
    return out


def pairs(df):
    return sorted((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect())


def test_every_stage_but_the_last_returns_documents(kept):
    for _, after in kept[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_keeps_what_the_classifier_accepts(spark, kept):
    before, after = kept[0]
    good = {r["doc_id"] for r in quality_model.quality_scores(before, table(spark, SF, "labels")).collect() if r["predicted"]}
    assert pairs(after) == [(i, t) for i, t in pairs(before) if i in good] and 0 < after.count() < before.count()


def test_one_document_of_each_group_stays(kept):
    before, after = (pairs(x) for x in kept[1])
    label = classes([fingerprint(t) for _, t in before], 2)
    first = {}
    for (doc_id, text), k in zip(before, label):
        first.setdefault(k, (doc_id, text))
    assert after == sorted(first.values()) and len(after) < len(before)


def test_repeated_bytes_go(kept):
    before, after = (pairs(x) for x in kept[2])
    seen, want = set(), []
    for doc_id, text in before:
        raw = text.encode()
        gone = brute(raw, 100, seen)
        want.append((doc_id, bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")))
    assert after == want and after != before


def test_documents_are_repeated_as_the_mix_takes_them(kept):
    before, after = kept[3]
    times = {r["doc_id"]: r["repeats"] for r in mixing.mix(before, mixing.cycling_weights(before)).collect()}
    assert pairs(after) == sorted(x for x in pairs(before) for _ in range(times[x[0]]))


def test_tokens_are_the_librarys(kept):
    before, after = kept[4]
    library = Tokenizer.from_file(vocabulary())
    want = sorted((i, library.encode(t, add_special_tokens=False).ids, hashlib.sha256(t.encode()).hexdigest()) for i, t in pairs(before))
    assert sorted((r["doc_id"], r["ids"], r["decoded_sha256"]) for r in after.collect()) == want


def test_run_equals_its_stages(spark, kept):
    names = ["doc_id", "n_tokens", "ids_sha256"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*names).collect())) == sorted(map(tuple, kept[-1][1].select(*names).collect()))


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_awkward_rows(spark, docs, no_docs, empty):
    rows = no_docs if empty else docs
    for _, stage in corpus_pipeline.STAGES:
        rows = saved(stage(spark, rows, SF), "test-awkward")
    assert (rows.count() == 0) == empty


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_sql(spark, name):
    from pathlib import Path

    from checks.run import connect, differences

    got = QUERIES[name](spark, SF).toPandas()
    assert differences(got, connect(Path(SF)).execute(ORACLES[name]).df()) == []


def test_the_rest_does_without(tmp_path):
    """Without the two folders and the pipeline the entry still imports and offers the other queries."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for name in ("__spark_entry__.py", "checks", "tallybasket"):
        copy = shutil.copytree if (root / name).is_dir() else shutil.copy
        copy(root / name, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if (root / name).is_dir() else {}))
    code = "import __spark_entry__ as e; n = set(e.queries()); assert len(n) > 100 and not any(x.startswith('op') for x in n) and 'pipeline' not in n"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
