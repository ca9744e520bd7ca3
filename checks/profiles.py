"""Segment lookups, profiles, revenue, reports and top rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import tables as t
from checks.tables import r
from tallybasket.operators import profile as ops
from tallybasket.operators import segments as seg
from tallybasket.operators.tiles import with_tiles

REPORT_DATE = dt.date(2024, 2, 1)


def distribution(spark, sf_dir):
    return ops.segment_distribution(t.clustered(spark, sf_dir), seg.segment_dimension(spark))


def revenue(spark, sf_dir):
    return ops.revenue_contribution(t.clustered(spark, sf_dir), seg.segment_dimension(spark))


def names(spark, sf_dir):
    rows = t.clustered(spark, sf_dir).select("CustomerID", "Cluster")
    return t.comparable(seg.with_segment_name(rows, seg.segment_dimension(spark)))


def labels(spark, sf_dir):
    rows = t.clustered(spark, sf_dir).select("CustomerID", "Cluster")
    return t.comparable(seg.with_segment_label(rows, seg.segment_dimension(spark)))


def reverse_names(spark, sf_dir):
    """Segment labels, one of them unknown to the dimension, back to ids."""
    dim = seg.segment_dimension(spark)
    rows = seg.with_segment_label(t.clustered(spark, sf_dir).select("CustomerID", "Cluster"), dim)
    return t.comparable(seg.cluster_of_name(rows.select("CustomerID", "Segment_Name"), dim))


def restricted_features(spark, sf_dir):
    """Full features of the customers that reached the scaled matrix, with their cluster."""
    from checks.customers import matrix
    from tallybasket.operators.clusters import attach_clusters

    clustered = t.clustered(spark, sf_dir)
    picked = matrix(spark, sf_dir).join(clustered.select("CustomerID", "Cluster"), "CustomerID").select("CustomerID", "Cluster")
    got = attach_clusters(clustered.drop("Cluster"), picked)
    return t.comparable(got.select("CustomerID", "Cluster", "Recency", "Frequency", "Monetary"))


def characteristics(spark, sf_dir):
    return t.comparable(ops.segment_characteristics(t.clustered(spark, sf_dir), seg.segment_dimension(spark)))


def spend_quarters(spark, sf_dir):
    """Statistics of four equal groups by spend."""
    feats = t.features(spark, sf_dir)
    tiled = with_tiles(feats, 4, {"Cluster": -F.col("Monetary")}, "CustomerID")
    tiled = tiled.withColumn("Cluster", F.col("Cluster") - 1)
    return t.comparable(ops.segment_characteristics(tiled, seg.segment_dimension(spark)))


def recommend(spark, sf_dir):
    got = ops.recommendations(t.clustered(spark, sf_dir), seg.segment_dimension(spark))
    joined = {c: F.array_join(c, "|") for c in ("actions", "kpis", "success_metrics")}
    return t.comparable(got.withColumns(joined))


def summary(spark, sf_dir):
    got = ops.executive_summary(distribution(spark, sf_dir), revenue(spark, sf_dir), REPORT_DATE)
    joined = {c: F.array_join(c, "|") for c in ("key_findings", "business_impact", "recommendations", "next_steps")}
    return t.comparable(got.withColumns(joined))


def report(spark, sf_dir):
    got = ops.full_report(t.clustered(spark, sf_dir), seg.segment_dimension(spark), REPORT_DATE)
    return got.select(F.to_json(F.struct("*")).alias("report"))


def report_figures(spark, sf_dir):
    """Figures of every part of the report, read out of its nested row."""
    row = ops.full_report(t.clustered(spark, sf_dir), seg.segment_dimension(spark), REPORT_DATE)
    names = row.select("*", F.explode(F.map_keys("revenue")).alias("Segment_Name"))
    name = F.col("Segment_Name")
    return t.comparable(
        names.select(
            "Segment_Name",
            F.col("distribution.total_customers").alias("total_customers"),
            F.element_at("distribution.segments", name)["count"].alias("count"),
            F.element_at(F.element_at("characteristics", name)["metrics"], F.lit("Monetary"))["median"].alias("median_spend"),
            F.element_at("revenue", name)["Revenue_Percentage"].alias("Revenue_Percentage"),
            F.element_at("recommendations", name)["key_characteristics"]["avg_recency"].alias("avg_recency"),
            F.element_at("recommendations", name)["business_actions"]["goal"].alias("goal"),
            F.col("executive_summary.project_overview.segments_identified").alias("segments_identified"),
        )
    )


def info(segment_id=None):
    def run(spark, sf_dir):
        return t.comparable(seg.segment_info(t.clustered(spark, sf_dir), seg.segment_dimension(spark), segment_id))

    return run


def clustered_round_trip(spark, sf_dir):
    """Clustered customers written, read back and named."""
    from tallybasket.sources.transactions import read_parquet_table, write_parquet_table

    back = read_parquet_table(spark, write_parquet_table(t.clustered(spark, sf_dir)))
    named = seg.with_segment_name(back, seg.segment_dimension(spark))
    return t.comparable(named.select("CustomerID", "Cluster", "Segment_Name", "Monetary"))


def one_cluster(spark, sf_dir):
    rows = t.clustered(spark, sf_dir).where(F.col("Cluster") == 2)
    return t.comparable(rows.select("CustomerID", "Cluster", "Monetary"))


def lines(spark, sf_dir):
    return t.comparable(ops.insight_lines(distribution(spark, sf_dir), revenue(spark, sf_dir)))


def extremes(spark, sf_dir):
    """Largest, smallest and top-revenue segment."""
    dist, money = distribution(spark, sf_dir), revenue(spark, sf_dir)
    by_count = dist.select("Segment_Name", "count")
    parts = [
        by_count.orderBy(F.desc("count"), "Segment_Name").limit(1).select(F.lit("largest").alias("what"), "Segment_Name"),
        by_count.orderBy("count", "Segment_Name").limit(1).select(F.lit("smallest").alias("what"), "Segment_Name"),
        money.orderBy(F.desc("Total_Revenue"), "Segment_Name").limit(1).select(F.lit("top_revenue").alias("what"), "Segment_Name"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def group_totals(spark, sf_dir):
    rows = seg.cluster_distribution(t.clustered(spark, sf_dir))
    return t.comparable(rows)


def ordered_clusters(spark, sf_dir):
    return t.comparable(seg.cluster_distribution(t.clustered(spark, sf_dir)).orderBy("Cluster"))


def clusters_in_order(spark, sf_dir):
    """The clusters with their place in order of id and the customers up to it."""
    order = Window.orderBy("Cluster")
    rows = seg.cluster_distribution(t.clustered(spark, sf_dir))
    return t.comparable(rows.select("Cluster", F.row_number().over(order).alias("place"), F.sum("count").over(order).alias("upto")))


def formatted(spark, sf_dir):
    """Sums of single customers as text with thousands separators and fixed decimals."""
    from tallybasket.functions import columns as fx

    feats = t.features(spark, sf_dir)
    return feats.select(
        "CustomerID",
        fx.whole_dollars(F.col("Monetary") + F.lit(0.001)).alias("dollars"),
        fx.one_decimal(F.col("AvgTransactionValue") + F.lit(0.0001)).alias("average"),
        F.format_string("$%.2f", F.col("Monetary")).alias("exact"),
    )


def map_lookup(spark, sf_dir):
    """Description of each row's cluster from a map, with a default."""
    known = F.create_map(*[F.lit(x) for row in seg.SEGMENTS for x in (row[0], row[2])])
    rows = t.clustered(spark, sf_dir)
    got = F.coalesce(F.try_element_at(known, F.col("Cluster")), F.lit(seg.NO_DESCRIPTION))
    return rows.select("CustomerID", got.alias("description"))


def info_as_json(spark, sf_dir):
    rows = seg.segment_info(t.clustered(spark, sf_dir), seg.segment_dimension(spark))
    return rows.select("segment_id", "segment_name", "size").select(
        F.col("segment_id").cast("long").alias("segment_id"),
        F.to_json(F.struct("segment_name", "size")).alias("document"),
    )


QUERIES = {
    "a14_clustered_table": clustered_round_trip,
    "a17_segment_info_source": info(),
    "b19_one_cluster": one_cluster,
    "c2_restricted_features": restricted_features,
    "c3_segment_names": names,
    "c3_segment_labels": labels,
    "c4_every_segment": lambda s, d: t.comparable(ops.segment_sizes(t.clustered(s, d), seg.segment_dimension(s))),
    "c5_cluster_of_name": reverse_names,
    "c6_group_totals": group_totals,
    "d15_distribution": lambda s, d: t.comparable(distribution(s, d)),
    "d16_characteristics": characteristics,
    "d16_spend_quarters": spend_quarters,
    "d17_revenue": lambda s, d: t.comparable(revenue(s, d)),
    "d18_recommendations": recommend,
    "d19_summary": summary,
    "d20_report": report,
    "d20_report_figures": report_figures,
    "d20_insight_lines": lines,
    "d21_segment_info": info(),
    "d21_segment_info_one": info(2),
    "d21_segment_info_unknown": info(9),
    "d22_cluster_distribution": ordered_clusters,
    "d27_box_plot": lambda s, d: t.comparable(ops.box_plot(t.clustered(s, d))),
    "d28_distribution_chart": lambda s, d: t.comparable(ops.distribution_chart(distribution(s, d))),
    "d28_revenue_charts": lambda s, d: t.comparable(ops.revenue_charts(revenue(s, d))),
    "f1_segments_by_count": lambda s, d: t.comparable(distribution(s, d).select("Segment_Name", "count")),
    "f2_by_cluster": clusters_in_order,
    "f4_extremes": extremes,
    "h3_half_even": lambda s, d: t.comparable(revenue(s, d).select("Segment_Name", "Revenue_Percentage", "Customer_Percentage"), 2),
    "h9_formatted_text": formatted,
    "h11_map_lookup": map_lookup,
    "h12_json_rows": info_as_json,
}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DIM_SQL = "dim AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {quoted(name)}, {quoted(desc)}, {quoted(goal)}, {quoted('|'.join(actions))}, {quoted('|'.join(kpis))})"
    for i, name, desc, goal, actions, kpis in seg.SEGMENTS
) + ') AS d("Cluster", "Segment_Name", description, goal, actions, kpis))'

BASE = f"WITH {t.CLUSTERED_SQL}, {DIM_SQL}"

_DIST = """dist AS (SELECT dim."Segment_Name", dim."Cluster" AS cluster_id, count(*) AS "count",
  count(*) * 100.0::DOUBLE / (SELECT count(*) FROM clustered) AS percentage, any_value(description) AS description,
  (SELECT count(*) FROM clustered) AS total_customers
  FROM clustered JOIN dim USING ("Cluster") GROUP BY dim."Segment_Name", dim."Cluster")"""

_REV = """grp AS (SELECT "Segment_Name", sum("Monetary") AS "Total_Revenue", avg("Monetary") AS "Avg_Revenue_per_Customer",
  median("Monetary") AS "Median_Revenue_per_Customer", count("Monetary") AS "Customer_Count"
  FROM clustered JOIN dim USING ("Cluster") GROUP BY "Segment_Name"),
rev AS (SELECT *, round_even("Total_Revenue" / (SELECT sum("Total_Revenue") FROM grp) * 100, 2) AS "Revenue_Percentage",
  round_even("Customer_Count" * 100.0::DOUBLE / (SELECT count(*) FROM clustered), 2) AS "Customer_Percentage",
  round_even("Avg_Revenue_per_Customer" / (SELECT max("Avg_Revenue_per_Customer") FROM grp) * 100, 2) AS "Revenue_per_Customer_Percentile"
  FROM grp)"""


def _characteristics(source: str) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT dim."Segment_Name", count(c."CustomerID") AS size,
  {r(f'count(c."CustomerID") * 100.0 / (SELECT count(*) FROM {source})')} AS percentage, '{m}' AS metric, {r(f'avg("{m}")')} AS "mean",
  {r(f'median("{m}")')} AS "median", {r(f'stddev_samp("{m}")')} AS std, {r(f'min("{m}")')} AS "min", {r(f'max("{m}")')} AS "max",
  {r(f'quantile_cont("{m}", 0.25)')} AS q25, {r(f'quantile_cont("{m}", 0.75)')} AS q75
  FROM dim LEFT JOIN {source} c ON c."Cluster" = dim."Cluster" GROUP BY dim."Segment_Name" """
        for m in ops.PROFILE_METRICS
    )
    return parts


def _info(where: str = "") -> str:
    return f"""{BASE} SELECT CAST("Cluster" AS BIGINT) AS segment_id, coalesce(any_value("Segment_Name"), 'Cluster_' || "Cluster") AS segment_name,
  coalesce(any_value(description), {quoted(seg.NO_DESCRIPTION)}) AS description, count(*) AS size,
  {r('count(*) * 100.0 / (SELECT count(*) FROM clustered)')} AS percentage, {r('avg("Recency")')} AS avg_recency,
  {r('avg("Frequency")')} AS avg_frequency, {r('avg("Monetary")')} AS avg_monetary
  FROM clustered LEFT JOIN dim USING ("Cluster") {where} GROUP BY "Cluster" """


def _pipe(texts) -> str:
    return quoted("|".join(texts))


_BOX = " UNION ALL ".join(
    f"""SELECT "Cluster", '{m}' AS metric, CAST("{m}" AS DOUBLE) AS value FROM clustered""" for m in ops.BOX_METRICS
)

_DISTRIBUTION_BY_ID = f"""{BASE} SELECT CAST("Cluster" AS BIGINT) AS "Cluster", count(*) AS "count",
  {r('count(*) * 100.0 / (SELECT count(*) FROM clustered)')} AS percentage FROM clustered GROUP BY "Cluster" """

ORACLES = {
    "a14_clustered_table": f"""{BASE} SELECT "CustomerID", CAST("Cluster" AS BIGINT) AS "Cluster", "Segment_Name", {r('"Monetary"')} AS "Monetary"
  FROM clustered LEFT JOIN dim USING ("Cluster")""",
    "a17_segment_info_source": _info(),
    "b19_one_cluster": f"""{BASE} SELECT "CustomerID", CAST("Cluster" AS BIGINT) AS "Cluster", {r('"Monetary"')} AS "Monetary"
  FROM clustered WHERE "Cluster" = 2""",
    "c2_restricted_features": f"""{BASE} SELECT "CustomerID", CAST("Cluster" AS BIGINT) AS "Cluster", "Recency", "Frequency",
  {r('"Monetary"')} AS "Monetary" FROM clustered WHERE "Monetary" > 0""",
    "c3_segment_names": f"""{BASE} SELECT "CustomerID", CAST("Cluster" AS BIGINT) AS "Cluster", "Segment_Name" FROM clustered LEFT JOIN dim USING ("Cluster")""",
    "c3_segment_labels": f"""{BASE} SELECT "CustomerID", CAST("Cluster" AS BIGINT) AS "Cluster",
  coalesce("Segment_Name", 'Cluster_' || "Cluster") AS "Segment_Name" FROM clustered LEFT JOIN dim USING ("Cluster")""",
    "c4_every_segment": f"""{BASE} SELECT CAST(dim."Cluster" AS BIGINT) AS "Cluster", "Segment_Name", count("CustomerID") AS size,
  {r('count("CustomerID") * 100.0 / (SELECT count(*) FROM clustered)')} AS percentage
  FROM dim LEFT JOIN clustered USING ("Cluster") GROUP BY dim."Cluster", "Segment_Name" """,
    "c5_cluster_of_name": f"""{BASE}, l AS (SELECT "CustomerID", coalesce("Segment_Name", 'Cluster_' || "Cluster") AS "Segment_Name"
  FROM clustered LEFT JOIN dim USING ("Cluster"))
SELECT "CustomerID", "Segment_Name", CAST(dim."Cluster" AS BIGINT) AS "Cluster" FROM l LEFT JOIN dim USING ("Segment_Name")""",
    "c6_group_totals": _DISTRIBUTION_BY_ID,
    "d15_distribution": f"""{BASE}, {_DIST} SELECT "Segment_Name", CAST(cluster_id AS BIGINT) AS cluster_id, "count",
  {r('percentage')} AS percentage, description, total_customers FROM dist""",
    "d16_characteristics": f"{BASE} {_characteristics('clustered')}",
    "d16_spend_quarters": f"""WITH {t.FEATURES_SQL}, {DIM_SQL}, quarters AS (SELECT *,
  ntile(4) OVER (ORDER BY "Monetary" DESC, "CustomerID") - 1 AS "Cluster" FROM feat) {_characteristics('quarters')}""",
    "d17_revenue": f"""{BASE}, {_REV} SELECT "Segment_Name", {", ".join(r(f'"{c}"') + f' AS "{c}"' for c in (
        "Total_Revenue", "Avg_Revenue_per_Customer", "Median_Revenue_per_Customer", "Revenue_Percentage", "Customer_Percentage",
        "Revenue_per_Customer_Percentile"))}, "Customer_Count" FROM rev""",
    "d18_recommendations": f"""{BASE} SELECT "Segment_Name", any_value(description) AS description, count("CustomerID") AS size,
  {r('avg("Recency")')} AS avg_recency, {r('avg("Frequency")')} AS avg_frequency, {r('avg("Monetary")')} AS avg_monetary,
  {r('avg("CustomerLifetime")')} AS customer_lifetime, any_value(goal) AS goal, any_value(actions) AS actions, any_value(kpis) AS kpis,
  {_pipe(ops.SUCCESS_METRICS)} AS success_metrics FROM dim LEFT JOIN clustered USING ("Cluster") GROUP BY "Segment_Name" """,
    "d19_summary": f"""{BASE}, {_DIST}, {_REV},
big AS (SELECT * FROM dist ORDER BY "count" DESC, "Segment_Name" LIMIT 1), small AS (SELECT * FROM dist ORDER BY "count", "Segment_Name" LIMIT 1),
top AS (SELECT * FROM rev ORDER BY "Total_Revenue" DESC, "Segment_Name" LIMIT 1),
a AS (SELECT * FROM rev ORDER BY "Segment_Name" LIMIT 1), z AS (SELECT * FROM rev ORDER BY "Segment_Name" DESC LIMIT 1)
SELECT {quoted(ops.SUMMARY_TITLE)} AS title, '2024-02-01' AS "date", (SELECT count(*) FROM clustered) AS total_customers,
  (SELECT count(*) FROM dist) AS segments_identified,
  'Identified ' || (SELECT count(*) FROM dist) || ' distinct customer segments|Largest segment: ' || big."Segment_Name" || ' (' || printf('%.1f', big.percentage)
  || '% of customers)|Smallest segment: ' || small."Segment_Name" || ' (' || printf('%.1f', small.percentage) || '% of customers)' AS key_findings,
  'Revenue concentration: ' || top."Segment_Name" || ' contributes ' || printf('%.1f', top."Revenue_Percentage") || '% of total revenue|Customer value range: $'
  || printf('%.2f', a."Avg_Revenue_per_Customer") || ' to $' || printf('%.2f', z."Avg_Revenue_per_Customer") || ' per customer' AS business_impact,
  {r('(SELECT min("Avg_Revenue_per_Customer") FROM rev)')} AS least_mean_revenue,
  {r('(SELECT max("Avg_Revenue_per_Customer") FROM rev)')} AS greatest_mean_revenue,
  {_pipe(ops.SUMMARY_RECOMMENDATIONS)} AS recommendations, {_pipe(ops.SUMMARY_NEXT_STEPS)} AS next_steps FROM big, small, top, a, z""",
    "d20_report_figures": f"""{BASE}, {_REV} SELECT "Segment_Name", (SELECT count(*) FROM clustered) AS total_customers, "Customer_Count" AS "count",
  {r('"Median_Revenue_per_Customer"')} AS median_spend, {r('"Revenue_Percentage"')} AS "Revenue_Percentage",
  {r('(SELECT avg("Recency") FROM clustered JOIN dim d USING ("Cluster") WHERE d."Segment_Name" = rev."Segment_Name")')} AS avg_recency,
  (SELECT goal FROM dim d WHERE d."Segment_Name" = rev."Segment_Name") AS goal, (SELECT count(*) FROM rev) AS segments_identified FROM rev""",
    "d20_insight_lines": f"""{BASE}, {_DIST}, {_REV} SELECT 'distribution' AS section, row_number() OVER (ORDER BY "count" DESC, "Segment_Name") AS line,
  "Segment_Name" || ': ' || "count" || ' customers (' || printf('%.1f', percentage) || '%)' AS "text" FROM dist
UNION ALL SELECT 'revenue', row_number() OVER (ORDER BY "Segment_Name"),
  "Segment_Name" || ': $' || format('{{:,.0f}}', "Total_Revenue") || ' (' || printf('%.1f', "Revenue_Percentage") || '% of total)' FROM rev
UNION ALL SELECT 'recommendations', line, "text" FROM (VALUES {", ".join(f"({i + 1}, {quoted(x)})" for i, x in enumerate(ops.SUMMARY_RECOMMENDATIONS[:3]))}) v(line, "text")""",
    "d21_segment_info": _info(),
    "d21_segment_info_one": _info('WHERE "Cluster" = 2'),
    "d21_segment_info_unknown": f"""{BASE} SELECT CAST(9 AS BIGINT) AS segment_id, 'Cluster_9' AS segment_name, {quoted(seg.NO_DESCRIPTION)} AS description,
  count(*) AS size, {r('count(*) * 100.0 / (SELECT count(*) FROM clustered)')} AS percentage, {r('avg("Recency")')} AS avg_recency,
  {r('avg("Frequency")')} AS avg_frequency, {r('avg("Monetary")')} AS avg_monetary FROM clustered WHERE "Cluster" = 9""",
    "d22_cluster_distribution": _DISTRIBUTION_BY_ID,
    "d27_box_plot": f"""{BASE}, v AS ({_BOX}), box AS (SELECT "Cluster", metric, count(value) AS n, quantile_cont(value, 0.25) AS q1,
  median(value) AS med, quantile_cont(value, 0.75) AS q3 FROM v GROUP BY "Cluster", metric),
ends AS (SELECT v."Cluster", v.metric, min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS lo,
  max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS hi,
  count(*) FILTER (NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outside
  FROM v JOIN box ON v."Cluster" = box."Cluster" AND v.metric = box.metric GROUP BY v."Cluster", v.metric)
SELECT CAST(box."Cluster" AS BIGINT) AS "Cluster", box.metric, n, {r('q1')} AS q1, {r('med')} AS "median", {r('q3')} AS q3,
  {r('least(lo, q1)')} AS whisker_low, {r('greatest(hi, q3)')} AS whisker_high, n_outside
FROM box JOIN ends ON box."Cluster" = ends."Cluster" AND box.metric = ends.metric""",
    "d28_distribution_chart": f"""{BASE}, {_DIST} SELECT "Segment_Name", "count", {r('percentage')} AS percentage,
  "count" || chr(10) || '(' || printf('%.1f', percentage) || '%)' AS label FROM dist""",
    "d28_revenue_charts": f"""{BASE}, {_REV} SELECT "Segment_Name", {r('"Revenue_Percentage"')} AS "Revenue_Percentage", "Customer_Count",
  {r('"Total_Revenue"')} AS "Total_Revenue", {r('"Avg_Revenue_per_Customer" / 10')} AS marker_size FROM rev""",
    "f1_segments_by_count": f'{BASE}, {_DIST} SELECT "Segment_Name", "count" FROM dist ORDER BY "count" DESC, "Segment_Name"',
    "f2_by_cluster": f"""{BASE}, g AS (SELECT "Cluster", count(*) AS n FROM clustered GROUP BY "Cluster")
SELECT CAST("Cluster" AS BIGINT) AS "Cluster", row_number() OVER (ORDER BY "Cluster") AS place, CAST(sum(n) OVER (ORDER BY "Cluster") AS BIGINT) AS upto FROM g""",
    "f4_extremes": f"""{BASE}, {_DIST}, {_REV} SELECT 'largest' AS what, (SELECT "Segment_Name" FROM dist ORDER BY "count" DESC, "Segment_Name" LIMIT 1) AS "Segment_Name"
UNION ALL SELECT 'smallest', (SELECT "Segment_Name" FROM dist ORDER BY "count", "Segment_Name" LIMIT 1)
UNION ALL SELECT 'top_revenue', (SELECT "Segment_Name" FROM rev ORDER BY "Total_Revenue" DESC, "Segment_Name" LIMIT 1)""",
    "h3_half_even": f"""{BASE}, {_REV} SELECT "Segment_Name", {r('"Revenue_Percentage"', 2)} AS "Revenue_Percentage",
  {r('"Customer_Percentage"', 2)} AS "Customer_Percentage" FROM rev""",
    "h9_formatted_text": f"""WITH {t.FEATURES_SQL} SELECT "CustomerID", format('{{:,.0f}}', "Monetary" + 0.001) AS dollars,
  printf('%.1f', "AvgTransactionValue" + 0.0001) AS average, '$' || printf('%.2f', "Monetary") AS exact FROM feat""",
    "h11_map_lookup": f"""{BASE} SELECT "CustomerID", coalesce(description, {quoted(seg.NO_DESCRIPTION)}) AS description
  FROM clustered LEFT JOIN dim USING ("Cluster")""",
    "h12_json_rows": f"""{BASE} SELECT CAST("Cluster" AS BIGINT) AS segment_id, '{{"segment_name":"' || coalesce(any_value("Segment_Name"), 'Cluster_' || "Cluster")
  || '","size":' || count(*) || '}}' AS document FROM clustered LEFT JOIN dim USING ("Cluster") GROUP BY "Cluster" """,
}
