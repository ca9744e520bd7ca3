"""From raw documents to tokens: quality, near-duplicates, repeated spans, source mix, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. ``run`` writes each
result as Parquet to the shared folder and rereads it as the next stage's ``docs``. All stages but the last
return the columns of ``documents``.

Rows that share a doc_id are kept or dropped together by the first two stages' decisions on that id, apart
from rows that repeat entirely, of which the near-duplicate stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybasket.llm import bpe, mixing, quality_model, simhash, suffix_dedup
from tallybasket.llm.common import saved, table
from tallybasket.llm.queries import vocabulary

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def _document(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` and nothing else."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")),
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with ``key``, a hash of their id and text: rows that agree in both are one document."""
    return _document(docs).withColumn("key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    A score depends on the text alone, so it is joined back by a hash of id and text.
    """
    keyed = _keyed(docs)
    scored = quality_model.quality_scores(keyed, table(spark, sf_dir, "labels"), carry=["key"])
    kept = saved(scored.where(F.col("predicted") == 1).select("key").distinct(), "pipeline-quality")
    return keyed.join(kept, "key", "left_semi").select(*DOCUMENT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the least id, of rows with that id the least hash."""
    keyed = _keyed(docs)
    groups = saved(simhash.simhash_groups(keyed, shingle_words=3, max_distance=2, carry=["key"]), "pipeline-groups")
    # Groups hold up to a third of all rows: the least is found with partial sums, nothing is gathered.
    rank = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "key")
    kept = groups.groupBy("class_id").agg(F.min(rank).alias("least")).select(F.col("least.key").alias("key"))
    kept = saved(kept, "pipeline-kept")
    # Rows that repeat entirely are one document; the first of them stays.
    one = Window.partitionBy("key").orderBy("lang", "source", "n_chars")
    stayed = keyed.join(kept, "key", "left_semi")
    return stayed.withColumn("copy", F.row_number().over(one)).where(F.col("copy") == 1).select(*DOCUMENT)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte spans of 100 and more that start earlier."""
    cleaned = suffix_dedup.remove_repeats(_document(docs), length=100, keep_text=True, carry=["lang", "source", "n_chars"])
    text = F.when(F.col("was_null"), F.lit(None)).otherwise(F.col("kept_text"))
    changed = F.col("n_removed") > 0
    n_chars = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    rows = _document(docs)
    mixed = mixing.mix(rows, mixing.cycling_weights(rows), carry=["text", "lang", "source", "n_chars"])
    return mixed.where(F.col("repeats") > 0).select(F.explode(F.sequence(F.lit(1), F.col("repeats"))), *DOCUMENT).select(*DOCUMENT)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document of the mix."""
    return bpe.encode_texts(_document(docs), vocabulary())


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_spans),
    ("mixing sources", source_mix),
    ("bpe encoding", encoding),
]

#: The classifier's fit and the tokenizer have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
