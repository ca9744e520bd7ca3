"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Each rule is a statistic of a document that is high in junk. Labelled good documents (quality 1) of every
stratum (language) are halved by a hash of the id. The first half proposes: for every level, from lax to
strict, each rule's cutoff is the quantile that so few of the half's good documents exceed, on the lax
levels widened by a factor. The second
half, the holdout, decides: of a level's rules together it counts how many good documents would be
rejected, and the level passes if the exact binomial (Clopper-Pearson) upper bound of the rate is at most
``max_false_rejection``. Levels are tried in order and the first failure ends the sequence, so the error
of the whole sequence is that of one test; over strata the error is divided by their number (Bonferroni).
With probability 1 - ``error`` no stratum loses more than that share of its good documents. A stratum in
which nothing passes, or without labels, keeps all that the base rules keep.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybasket.llm.common import any_of, saved, text_or_empty
from tallybasket.llm.statistics import with_statistics

MAX_FALSE_REJECTION = 0.03
ERROR = 0.05
#: From lax to strict: the share of the first half's good documents that a rule may reject, and the factor that widens its cutoff.
LEVELS = ((0.0, 4.0), (0.0, 2.0), (0.0, 1.5), (0.0, 1.2), (0.0, 1.0), (0.0005, 1.0), (0.001, 1.0))
#: Added to a cutoff for every 1 that its factor is above 1, for rules that no good document touches.
MARGIN = 0.01
#: Accuracy of the quantile sketches.
ACCURACY = 10_000
NO_STRATUM = "\x00null"


def rules() -> dict[str, Column]:
    """Statistics that are high in junk."""
    c = {x: F.col(x).cast("double") for x in ("n_symbols", "n_symbol_words", "n_caps_words", "n_pipes", "n_exclamations", "n_dup_lines", "n_repeat_words", "n_digits", "n_punctuation", "n_long_words")}
    words, chars, lines = (F.greatest(F.col(x).cast("double"), F.lit(1.0)) for x in ("n_words", "word_chars", "n_lines"))
    return {
        "symbols": c["n_symbols"] / chars,
        "symbol_words": c["n_symbol_words"] / words,
        "capitals": c["n_caps_words"] / words,
        "pipes": c["n_pipes"] / words,
        "exclamations": c["n_exclamations"] / words,
        "repeated_lines": c["n_dup_lines"] / lines,
        "repeated_words": c["n_repeat_words"] / words,
        "digits": c["n_digits"] / chars,
        "punctuation": c["n_punctuation"] / chars,
        "long_words": c["n_long_words"] / words,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p): the regularised incomplete beta function at 1 - p with n - k and k + 1."""
    if k >= n or p <= 0:
        return 1.0
    a, b, x = float(n - k), float(k + 1), 1.0 - p
    if x <= 0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, 1 - x) / b


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 100_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + step / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return value


def passes(rejected: int, n: int, rate: float, error: float) -> bool:
    """Whether the Clopper-Pearson upper bound of the rejected share, at that error, is at most ``rate``."""
    return n > 0 and binomial_tail(rejected, n, rate) <= error


def choose_cutoffs(good: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """Per stratum the level that passed and its cutoffs: ``stratum``, ``level``, ``cutoffs`` (array<double>).

    ``good``: labelled good documents that the base rules keep, with ``stratum``, ``text_hash`` and ``v`` (array of
    the rules' values). Copies of a text are one observation, in one half: the binomial bound is about independent documents.
    Without ``text_hash`` each ``doc_id`` is one.
    """
    names, observation = list(rules()), "text_hash" if "text_hash" in good.columns else "doc_id"
    good = saved(good.dropDuplicates(["stratum", observation]), "rules-observations")
    half = F.pmod(F.xxhash64(observation, F.lit(3)), F.lit(2))
    shares = [1.0 - share for share, _ in LEVELS]
    proposed = good.where(half == 0).groupBy("stratum").agg(
        *[F.percentile_approx(F.col("v")[i], shares, ACCURACY).alias(name) for i, name in enumerate(names)]
    )
    levels = F.array(
        *[F.array(*[F.col(name)[i] * factor + (factor - 1) * MARGIN for name in names]) for i, (_, factor) in enumerate(LEVELS)]
    )
    proposed = saved(proposed.select("stratum", levels.alias("levels")), "rules-proposed")
    over = lambda i: any_of([F.col("v")[j] > F.col("levels")[i][j] for j in range(len(names))])
    counted = (
        good.where(half == 1)
        .join(proposed, "stratum")
        .groupBy("stratum")
        .agg(F.count("*").alias("n"), *[F.sum(over(i).cast("long")).alias(f"rejected{i}") for i in range(len(LEVELS))])
    )
    counted = saved(counted, "rules-counted")
    each = error / max(counted.count(), 1)

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            chosen = []
            for row in frame.to_dict("records"):
                level = -1
                while level + 1 < len(LEVELS) and passes(row[f"rejected{level + 1}"], row["n"], max_false_rejection, each):
                    level += 1
                chosen.append(level)
            yield pd.DataFrame({"stratum": frame["stratum"], "level": chosen})

    decided = counted.mapInPandas(decide, "stratum string, level int").where(F.col("level") >= 0)
    return decided.join(proposed, "stratum").select("stratum", "level", F.col("levels")[F.col("level")].alias("cutoffs"))


def apply_rules(docs: DataFrame, labels: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """Statistics and verdict of every row of ``docs``.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and
    ``level`` (null where no cutoff passed). Null texts count as empty, a null language is a stratum of its own,
    labels that are null, differ for one id, or belong to no document are left out. Repeated rows give repeated
    rows, and texts that repeat count once where cutoffs are chosen; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_STRATUM)).alias("stratum"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
        text_or_empty().alias("text"),
    )
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measured = with_statistics(rows).select("doc_id", "stratum", "text_hash", *base, base_failed().alias("base_failed"), F.array(*rules().values()).alias("v"))
    measured = saved(measured, "rules-statistics")
    known = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min("quality").alias("least"), F.max("quality").alias("most")).where(F.col("least") == 1).select("doc_id")
    good = saved(measured.where(~F.col("base_failed")).join(known, "doc_id").select("stratum", "text_hash", "v"), "rules-good")
    cutoffs = saved(choose_cutoffs(good, max_false_rejection, error), "rules-cutoffs")
    judged = measured.join(cutoffs, "stratum", "left")
    over = any_of([F.col("v")[j] > F.col("cutoffs")[j] for j in range(len(rules()))])
    kept = ~F.col("base_failed") & ~F.coalesce(over, F.lit(False))
    return judged.select("doc_id", *base, "base_failed", kept.alias("kept"), "level")
