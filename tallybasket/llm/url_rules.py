"""Allow and block rules for URLs by a sort-merge range join.

**Keys.** A host's labels are reversed and each followed by a question mark, which no host or path holds
(``www.example.com`` gives ``com?example?www?``), so a host and all its subdomains are the keys with one
prefix: one interval of the sorted order. A rule (host, path) is the interval of its host; nested hosts give nested intervals.

**Sweep.** Pages are sorted by key over range partitions; the id breaks ties, so that one host, or one
URL, with a third of all rows still spreads. Each task sweeps its sorted keys beside the sorted rules and
keeps a stack of the rules whose interval is open: those of hosts that enclose the current key. Only these
are tried on the page's path, the longest rule first.

**Rules.** They go to every task, at most ``RULES_AT_ONCE`` at a time: a larger table is cut into slices,
the sorted pages are swept once for each, and the longest rule over all slices is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybasket.llm.common import prepare_tasks, saved, single

RULES_AT_ONCE = 100_000
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased, nothing else."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(raw, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_key(host: Column) -> Column:
    return F.concat(F.concat_ws("?", F.reverse(F.split(host, r"\."))), F.lit("?"))


def _sweep(batches: Iterator[pa.RecordBatch], rules: list[tuple[str, str, str, str]]) -> Iterator[pa.RecordBatch]:
    """``rules``: (key, path, rule, verdict), sorted by key; the keys of the batches are sorted as well."""
    following, stack = 0, []  # the next rule to open, and the open ones: (key, its rules, longest first)
    for batch in batches:
        names, verdicts, sizes = [], [], []
        for key, path in zip(single(batch.column("key")).to_pylist(), single(batch.column("path")).to_pylist()):
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            while following < len(rules) and rules[following][0] <= key:
                opening = rules[following][0]
                first = following
                while following < len(rules) and rules[following][0] == opening:
                    following += 1
                # Rules that the sweep has passed without a page in their interval never open.
                if key.startswith(opening):
                    while stack and not opening.startswith(stack[-1][0]):
                        stack.pop()
                    stack.append((opening, rules[first:following]))
            fits = [r for _, own in stack for r in own if path.startswith(r[1])]
            best = max(fits, key=lambda r: (len(r[2]), r[0], r[1]), default=None)
            names.append(best[2] if best else None)
            verdicts.append(best[3] if best else None)
            sizes.append(len(best[0]) if best else None)
        columns = [batch.column(c) for c in ("page_id", "host", "path")]
        columns += [pa.array(names, pa.string()), pa.array(verdicts, pa.string()), pa.array(sizes, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "path", "rule", "rule_verdict", "rule_host"])


def judge_urls(pages: DataFrame, rules: DataFrame, rules_at_once: int = RULES_AT_ONCE) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict``; a rule is named by host and path together. It fits its
    host and all subdomains, if the page's path begins with the rule's; the longest name wins, among equals
    the longer host; of rules with one host and path the least verdict counts. Pages without a fitting rule
    get a null rule and the verdict ``allow``, so do null or empty URLs and those without ``://``, whose host
    and path are empty. Rows that repeat give repeated rows, a null id stays null; rules with a null or empty
    host fit nothing. An empty table gives an empty result; other columns are ignored.
    """
    prepare_tasks(pages.sparkSession)
    url = F.col("url").cast("string")
    host = host_of(url)
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path_of(url).alias("path"))
    keyed = keyed.withColumn("key", F.concat(reversed_key(F.col("host")), F.col("path")))
    tidy = (
        rules.where(F.length("host") > 0)
        .groupBy(F.col("host"), F.coalesce("path", F.lit("")).alias("path"))
        .agg(F.min("verdict").alias("verdict"))
        .select(reversed_key(F.col("host")).alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict")
    )
    tidy = saved(tidy, "url-rules")
    slices = -(-tidy.count() // rules_at_once) or 1
    ordered = keyed.repartitionByRange("key", "page_id").sortWithinPartitions("key")
    if slices > 1:
        ordered = saved(ordered.withColumn("at", F.spark_partition_id()), "url-keys")
        ordered = ordered.repartitionByRange("key", "page_id").sortWithinPartitions("key").drop("at")
    part = F.pmod(F.xxhash64("rule"), F.lit(slices))
    swept = None
    for i in range(slices):
        own = [tuple(r) for r in tidy.where(part == i).collect()]
        own.sort(key=lambda r: (r[0].encode(), r[1].encode()))
        one = ordered.mapInArrow(
            lambda batches, own=own: _sweep(batches, own),
            "page_id long, host string, path string, rule string, rule_verdict string, rule_host int",
        )
        swept = one if swept is None else swept.unionByName(one)
    if slices > 1:
        key = ["page_id", "host", "path"]
        order = F.struct(F.length("rule"), "rule_host", "rule")
        best = swept.groupBy(*key).agg(
            F.max_by(F.struct("rule", "rule_verdict"), order).alias("best")
        ).select(*key, "best.rule", "best.rule_verdict")
        same = [keyed[c].eqNullSafe(best[c]) for c in key]
        swept = keyed.join(best, same).select(*[keyed[c] for c in key], "rule", "rule_verdict")
    return swept.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"))
