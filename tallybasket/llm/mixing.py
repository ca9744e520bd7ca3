"""Mixing sources to target weights by capped water-filling; DataFrame functions only.

**Targets.** Every source has a weight and a size; the mix has a total. A source takes at most
``max_epochs`` times its size. Sources whose share would exceed that are clamped, what is left is shared
among the others by weight, and this repeats until no share is above its cap. A round is one aggregate
over the table of sources; the number of rounds is at most the number of clamped sources.

**Taking.** A source with target t and size s repeats all documents floor(t / s) times and takes one more
copy of a seeded part of them. Each row has a pseudo-random 40-bit number from its id and the seed;
the extra copies are those below a threshold per source. The threshold is found by histograms: 1,024
buckets of the leading bits, then 1,024 of the next in the one bucket that holds it, each a small sum per
source, so no source is ever sorted or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybasket.llm.common import saved, text_or_empty

BUCKETS = 1024
#: Stands for the null source in joins; no source of that name can be told from it, so it holds a NUL.
NO_SOURCE = "\x00null"


def n_words(text: Column) -> Column:
    """Number of words: as many as there are spaces before a word, in a text with one more in front."""
    trimmed = F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def source_key() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE))


def with_draw(rows: DataFrame, repeated: DataFrame, seed: int) -> DataFrame:
    """Add ``draw``, a 40-bit number of a row: of its id alone, the same in every run, or of its id and place if the id is in ``repeated``.

    Rows that share an id would otherwise be taken all or not at all, and one that makes a third of its source would miss the target.
    """
    found = rows.join(repeated, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    place = F.when(F.col("_again"), F.concat(F.lit(":"), F.monotonically_increasing_id().cast("string"))).otherwise("")
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), place)
    return found.withColumn("draw", F.conv(F.substring(F.md5(text.cast("binary")), 1, 10), 16, 10).cast("long")).drop("_id", "_again")


def water_fill(sources: DataFrame, total: Column, max_epochs: float) -> DataFrame:
    """Add ``target`` to ``sources`` (``source_key``, ``size``, ``weight``; written already).

    ``total`` is an aggregate over sources. Sources of weight zero or size zero get 0. If all caps together
    are below the total, every source with a weight gets its cap.
    """
    cap = F.col("size") * F.lit(float(max_epochs))
    level = None  # (what the clamped take, the weight of the others), after each round
    whole = sources.agg(total.alias("total")).first()["total"] or 0.0
    clamped = F.lit(False)
    count = 0
    while True:
        row = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~clamped & (F.col("weight") > 0), F.col("weight"))), F.lit(0)).alias("open"),
            F.coalesce(F.sum(F.when(clamped, 1)), F.lit(0)).alias("n"),
        ).first()
        if level is not None and row["n"] == count:
            break
        count, level = row["n"], (float(whole) - row["taken"], float(row["open"]))
        if not level[1]:
            break
        # Shares only grow from round to round, so a source once clamped stays so.
        clamped = (F.col("weight") > 0) & (F.col("weight") * F.lit(level[0]) / F.lit(level[1]) > cap)
    share = F.col("weight") * F.lit(level[0]) / F.lit(level[1]) if level[1] else F.lit(0.0)
    target = F.when(F.col("weight") <= 0, 0.0).when(clamped, cap).otherwise(share)
    return sources.withColumn("target", target.cast("double"))


def sized(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``source_key``, ``size`` (words) and the columns in ``carry`` of every row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source_key().alias("source_key"),
        n_words(text_or_empty()).alias("size"),
        *carry,
    )


def _threshold(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source the number ``below``: documents with a smaller draw take one more copy.

    ``rows``: source_key, size, draw; ``wanted``: source_key, extra (words the extra copies should have).
    """
    high, low = F.shiftright("draw", 30), F.shiftright("draw", 20).bitwiseAND(F.lit(BUCKETS - 1))
    cells = saved(
        rows.select("source_key", "size", high.alias("high"), low.alias("low"))
        .groupBy("source_key", "high", "low")
        .agg(F.sum("size").alias("size")),
        "mixing-cells",
    )
    upper = cells.groupBy("source_key", "high").agg(F.sum("size").alias("size"))
    running = Window.partitionBy("source_key").orderBy("high")
    before = upper.withColumn("upto", F.sum("size").over(running)).join(wanted, "source_key")
    # The first bucket whose running sum passes what is wanted; all of a source if none does.
    edge = (
        before.where(F.col("upto") > F.col("extra"))
        .groupBy("source_key")
        .agg(F.min_by(F.struct("high", (F.col("upto") - F.col("size")).alias("base"), "extra"), "high").alias("e"))
        .select("source_key", "e.*")
    )
    inner = Window.partitionBy("source_key").orderBy("low")
    fine = cells.join(edge, ["source_key", "high"]).withColumn("upto", F.col("base") + F.sum("size").over(inner))
    # A cell of 2**-20 of the source is taken whole if that brings the sum nearer to what is wanted.
    taken = F.abs(F.col("upto") - F.col("extra")) < F.abs(F.col("upto") - F.col("size") - F.col("extra"))
    cut = fine.groupBy("source_key").agg(
        F.min(F.when(~((F.col("upto") <= F.col("extra")) | taken), F.col("high") * BUCKETS + F.col("low"))).alias("cell"),
        F.max(F.col("high") * BUCKETS + BUCKETS).alias("end"),
    )
    return wanted.join(cut, "source_key", "left").select(
        "source_key",
        F.when(F.col("extra") <= 0, F.lit(0))
        .otherwise(F.coalesce(F.shiftleft(F.coalesce("cell", "end"), 20), F.lit(1 << 40)))
        .alias("below"),
    )


def mix(
    docs: DataFrame,
    weights: DataFrame,
    total_share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 7,
    carry: Sequence[str] = (),
) -> DataFrame:
    """How often each document is taken so that its source comes to its target.

    ``weights`` has ``source`` (null for rows without one) and ``weight``; a source it lacks has weight 0.
    The mix has ``total_share`` times all words. Returns per row of ``docs``: doc_id, source_key, size,
    source_size, target, repeats (int), taken = repeats * size, and the columns named in ``carry``. ``repeats`` never exceeds ceil(max_epochs).
    Null or empty texts have size 0 and are repeated like others. Rows that share an id draw a number each, by their place in the
    table, so that a source with a hot id meets its target too; which of them are taken depends on the table's layout. A null doc_id
    is an id. An empty table gives an empty result; a carried column named like one of the results is refused.
    """
    clash = set(carry) & {"doc_id", "source_key", "size", "source_size", "target", "repeats", "taken", "draw", "whole", "extra", "below"}
    if clash:
        raise ValueError(f"carried columns clash with results: {sorted(clash)}")
    rows = saved(sized(docs), "mixing-sizes")
    repeated = rows.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    repeated = saved(repeated.select("_id", F.lit(True).alias("_again")), "mixing-repeated")
    sizes = rows.groupBy("source_key").agg(F.sum("size").alias("size"))
    weighted = sizes.join(
        weights.select(source_key().alias("source_key"), F.col("weight").cast("double")), "source_key", "left"
    ).select("source_key", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sources = saved(weighted, "mixing-sources")
    filled = water_fill(sources, F.sum("size") * F.lit(float(total_share)), max_epochs)
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(F.lit(0.0))
    plan = filled.select("source_key", F.col("size").alias("source_size"), "target", F.floor(rate).cast("int").alias("whole"))
    plan = plan.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = saved(plan, "mixing-plan")
    drawn = with_draw(rows, repeated, seed)
    below = _threshold(drawn, plan.select("source_key", "extra"))
    full = saved(plan.join(below, "source_key"), "mixing-thresholds")
    repeats = (F.col("whole") + (F.col("draw") < F.col("below")).cast("int")).alias("repeats")
    # The texts, if they are carried, are not written with the sizes but read again from ``docs``.
    drawn = with_draw(sized(docs, carry), repeated, seed) if carry else drawn
    out = drawn.join(full, "source_key").select("doc_id", "source_key", "size", "source_size", "target", repeats, *carry)
    return out.withColumn("taken", F.col("repeats").cast("long") * F.col("size"))


def cycling_weights(docs: DataFrame, cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Weights for the sources in code point order, null last, repeating ``cycle``; one row per source."""
    last = F.when(F.col("k") == NO_SOURCE, 1).otherwise(0)
    # Sources stand in order over range partitions; a row's place is its place in its partition and the rows of those before.
    names = docs.select(source_key().alias("k")).distinct().repartitionByRange(last, "k")
    names = saved(names.select("k", F.spark_partition_id().alias("part")), "mixing-names")
    sizes = names.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    at = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(last, "k")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (at % len(cycle) + 1).cast("int"))
    return names.join(before, "part").select(F.when(F.col("k") != NO_SOURCE, F.col("k")).alias("source"), weight.alias("weight"))
