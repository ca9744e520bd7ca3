"""Distances, cluster measures, k-means, PCA, density clusters and the comparison of algorithms."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fits
from checks import tables as t
from checks.customers import FINAL, matrix, scaled_sql
from checks.tables import r
from tallybasket.operators import comparison, dbscan, kmeans, metrics, ward
from tallybasket.operators import preparation as prep
from tallybasket.session import materialize

VECTOR = [f"e{i}" for i in range(64)]


def vectors(spark, sf_dir):
    """Embeddings with one column per dimension and their given label."""
    rows = t.read(spark, sf_dir, "embeddings")
    wide = rows.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(VECTOR)])
    return materialize(wide, "vectors")


def scaled(spark, sf_dir):
    """Scaled customer matrix."""
    rows = matrix(spark, sf_dir)
    return materialize(prep.scale_features(rows, prep.Scaler.from_table(prep.scaler_parameters(rows, FINAL))), "scaled")


def labelled(spark, sf_dir):
    """Scaled customers with the market segment as label."""
    groups = t.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"), "c_mktsegment")
    market = F.array(*[F.lit(m) for m in t.MARKETS])
    label = (F.array_position(market, F.col("c_mktsegment")) - 1).cast("int")
    joined = scaled(spark, sf_dir).join(groups, "CustomerID").withColumn("label", label).drop("c_mktsegment")
    return materialize(joined, "labelled")


def market_centres(spark, sf_dir):
    """Means of the market segments as given centres, in the order of the label."""
    rows = labelled(spark, sf_dir)
    means = metrics.centroids(rows, "label", FINAL).orderBy("label").collect()
    return rows, [[row[f"c_{c}"] for c in FINAL] for row in means]


def nearest(spark, sf_dir):
    rows, centres = market_centres(spark, sf_dir)
    return t.comparable(kmeans.assign_clusters(rows, FINAL, centres).select("CustomerID", "Cluster", "Distance_to_Center"))


def all_distances(spark, sf_dir):
    rows, centres = market_centres(spark, sf_dir)
    d2 = kmeans.distances_to_centres(FINAL, centres)
    flat = [F.sqrt(d2[i]).alias(f"to_{i}") for i in range(len(centres))]
    return t.comparable(rows.select("CustomerID", *flat))


def grouped_inertia(spark, sf_dir):
    return t.comparable(metrics.inertia(vectors(spark, sf_dir), "label", VECTOR))


def customer_inertia(spark, sf_dir):
    return t.comparable(metrics.inertia(labelled(spark, sf_dir), "label", FINAL))


def vector_silhouette(spark, sf_dir):
    return t.comparable(metrics.silhouettes(vectors(spark, sf_dir), ["label"], VECTOR, side_points=150, block_rows=64), 6)


def customer_silhouette(spark, sf_dir):
    return t.comparable(metrics.silhouettes(labelled(spark, sf_dir), ["label"], FINAL), 6)


def coarser_labels(spark, sf_dir):
    """Vectors under labellings with 2 to 6 clusters: the given label folded to k values."""
    rows = vectors(spark, sf_dir)
    folded = {f"k{k}": (F.floor(F.col("label") * k / 10)).cast("int") for k in range(2, 7)}
    return materialize(rows.withColumns(folded), "folded")


def label_sweep(spark, sf_dir):
    """Inertia per k for the folded labels."""
    rows, parts = coarser_labels(spark, sf_dir), []
    for k in range(2, 7):
        parts.append(metrics.inertia(rows, f"k{k}", VECTOR).withColumn("k", F.lit(k)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return materialize(out, "label-sweep")


def silhouette_sweep(spark, sf_dir):
    got = metrics.silhouettes(coarser_labels(spark, sf_dir), [f"k{k}" for k in range(2, 7)], VECTOR, side_points=150, block_rows=64)
    return materialize(got.withColumn("k", F.expr("cast(substring(labelling, 2) as int)")), "silhouette-sweep")


def best_k(spark, sf_dir):
    return t.comparable(metrics.best_silhouette(silhouette_sweep(spark, sf_dir)))


def noise(spark, sf_dir):
    """Market label with the last market as noise."""
    return labelled(spark, sf_dir).withColumn("label", F.when(F.col("label") == 4, -1).otherwise(F.col("label")))


def without_noise(spark, sf_dir):
    return t.comparable(noise(spark, sf_dir).where("label <> -1").select("CustomerID", "label"))


def clusters_without_noise(spark, sf_dir):
    return t.comparable(
        noise(spark, sf_dir).agg(
            F.countDistinct(F.when(F.col("label") != -1, F.col("label"))).alias("n_clusters"),
            F.count_if(F.col("label") == -1).alias("n_noise"),
        )
    )


# Orthonormal loadings of two components over the six features.
GIVEN_LOADINGS = [[0.5, 0.5, 0.5, 0.5, 0.0, 0.0], [0.5, -0.5, 0.5, -0.5, 0.0, 0.0]]


def given_projection(spark, sf_dir):
    rows = scaled(spark, sf_dir)
    got = kmeans.project(rows, kmeans.Projection(FINAL, [0.0] * 6, GIVEN_LOADINGS, []))
    return t.comparable(got.select("CustomerID", "PCA1_2D", "PCA2_2D"))


def fit_facts(labelled, cols, fit):
    """What holds of any k-means fit, beside the number of customers, as one row."""
    means = metrics.centroids(labelled, "Cluster", cols)
    centre = F.array(*[F.array(*[F.lit(v) for v in c]) for c in fit.centres])
    gaps = [F.abs(F.col(f"c_{c}") - centre[F.col("Cluster")][i]) for i, c in enumerate(cols)]
    facts = means.agg(
        F.sum("n").alias("customers"), F.count(F.lit(1)).alias("clusters"), (F.max(F.greatest(*gaps)) < 0.01).alias("centres_are_means")
    )
    own = labelled.agg(F.sum(F.pow("Distance_to_Center", F.lit(2))).alias("s")).scalar()
    return facts.withColumn("inertia_is_sum", F.abs(own / F.lit(fit.inertia) - 1) < 1e-6)


def fit_rows(fit, sizes=None):
    """One row per cluster of a fit: its number, its customers, the cost of the whole fit and its centre."""
    rows = [(i, n, fit.inertia, *map(float, c)) for i, (c, n) in enumerate(zip(fit.fitted, sizes or fit.sizes))]
    return rows, "Cluster long, n long, inertia double, " + ", ".join(f"{c} double" for c in FINAL)


def kmeans_clusters(spark, sf_dir):
    """Four clusters after the given number of passes from given centres."""
    rows = scaled(spark, sf_dir)
    fit = kmeans.fit_kmeans(rows, FINAL, 4, fits.starts(rows, FINAL, 4), **fits.GIVEN)
    return t.comparable(spark.createDataFrame(*fit_rows(fit)))


def best_fit(spark, sf_dir):
    """Of ten drawn starts the best: centres are means, the inertia is the sum of squares, and not above that of given starts."""
    rows = scaled(spark, sf_dir)
    fit = kmeans.fit_kmeans(rows, FINAL, 4)
    given = kmeans.fit_kmeans(rows, FINAL, 4, fits.starts(rows, FINAL, 4), **fits.GIVEN)
    facts = fit_facts(kmeans.assign_clusters(rows, FINAL, fit.centres), FINAL, fit)
    return facts.withColumn("at_most_given", F.lit(fit.inertia <= given.inertia * (1 + 1e-6)))


def kmeans_sweep(spark, sf_dir):
    """All measures for k from 2 to 10, each from given centres."""
    rows = scaled(spark, sf_dir)
    given = {k: fits.starts(rows, FINAL, k) for k in range(2, 11)}
    table = materialize(kmeans.sweep(rows, FINAL, max_clusters=10, starts=given, **fits.GIVEN), "sweep-table")
    digits = {"inertia": 4, "silhouette": 6, "davies_bouldin": 6, "calinski_harabasz": 3}
    rounded = [F.round(F.col(c) + F.lit(t.shift(d)), d).alias(c) for c, d in digits.items()]
    return table.select(F.col("k").cast("long").alias("k"), *rounded)


def drawn_sweep(spark, sf_dir):
    """The sweep as a user runs it, ten drawn starts for each k: rows only, since the draw has no SQL."""
    return t.comparable(kmeans.sweep(scaled(spark, sf_dir), FINAL, max_clusters=10))


def pca_coordinates(spark, sf_dir):
    rows = scaled(spark, sf_dir)
    for n in (2, 3):
        rows = kmeans.project(rows, kmeans.fit_pca(rows, FINAL, n)[1])
    return t.comparable(rows.select("CustomerID", *PCA_NAMES))


def pca_loadings(spark, sf_dir):
    """Loadings and explained share of every component."""
    _, found = kmeans.fit_pca(scaled(spark, sf_dir), FINAL, 3)
    rows = [(i + 1, share, *v) for i, (v, share) in enumerate(zip(found.loadings, found.explained))]
    return t.comparable(spark.createDataFrame(rows, "component long, explained double, " + ", ".join(f"{c} double" for c in FINAL)))


PCA_NAMES = ["PCA1_2D", "PCA2_2D", "PCA1_3D", "PCA2_3D", "PCA3_3D"]


def core_flags(spark, sf_dir):
    rows = scaled(spark, sf_dir)
    grid = dbscan.build_grid(rows, "CustomerID", FINAL, dbscan.EPS)
    flags = dbscan.core_points(grid, dbscan.MIN_SAMPLES).select("x", "is_core")
    joined = rows.withColumn("x", F.array(*[F.col(c) for c in FINAL])).join(flags, "x")
    return t.comparable(joined.select("CustomerID", "is_core"))


def density_clusters(spark, sf_dir):
    return t.comparable(dbscan.dbscan(scaled(spark, sf_dir), "CustomerID", FINAL))


#: Summaries of the hierarchy that SQL merges too.
SUMMARIES = 48


def ward_clusters(spark, sf_dir):
    """Every customer's cluster of four, merged from the bottom over at most 48 grid cells."""
    found = ward.ward(scaled(spark, sf_dir), FINAL, 4, max_summaries=SUMMARIES)
    return t.comparable(found.select("CustomerID", "Cluster"))


def ward_heights(spark, sf_dir):
    """Height and number of customers of every merge."""
    return t.comparable(ward.dendrogram(scaled(spark, sf_dir), FINAL, max_summaries=SUMMARIES).select("step", "height", "points"))


def full_ward(spark, sf_dir):
    """Sizes of the four clusters over all different customers: rows only, the merges are too many for SQL."""
    found = ward.ward(scaled(spark, sf_dir), FINAL, 4)
    return t.comparable(found.groupBy("Cluster").agg(F.count(F.lit(1)).alias("n")))


def given_algorithms(spark, sf_dir):
    """Comparison rows of the algorithms that SQL can follow: k-means from given centres, and density clusters."""
    rows = scaled(spark, sf_dir)
    begin = fits.starts(rows, FINAL, 4)

    def from_given(matrix, cols, k):
        return kmeans.assign_clusters(matrix, cols, kmeans.fit_kmeans(matrix, cols, k, begin, **fits.GIVEN).centres).drop("Distance_to_Center")

    runs = {"KMeans": from_given, "DBSCAN": comparison.ALGORITHMS["DBSCAN"]}
    scores, labels = comparison.compare(rows, FINAL, 4, runs)
    sizes = labels.groupBy("algorithm").agg(F.count(F.lit(1)).alias("customers"))
    return t.comparable(scores.join(sizes, "algorithm"), 6)


def algorithms(spark, sf_dir):
    """All algorithms with their own starts: number of clusters, silhouette, error and customers."""
    scores, labels = comparison.compare(scaled(spark, sf_dir), FINAL)
    sizes = labels.groupBy("algorithm").agg(F.countDistinct("CustomerID").alias("customers"))
    return t.comparable(scores.join(sizes, "algorithm", "left"), 6)


QUERIES = {
    "i4_nearest_centre": nearest,
    "i5_distances": all_distances,
    "i6_inertia": grouped_inertia,
    "i6_customer_inertia": customer_inertia,
    "i7_silhouette": vector_silhouette,
    "i7_customer_silhouette": customer_silhouette,
    "i7_silhouette_sweep": lambda s, d: t.comparable(silhouette_sweep(s, d), 6),
    "i7_squared_silhouette": lambda s, d: t.comparable(metrics.squared_silhouettes(labelled(s, d), ["label"], FINAL), 6),
    "i8_davies_bouldin": lambda s, d: t.comparable(metrics.davies_bouldin(vectors(s, d), "label", VECTOR), 6),
    "i8_customer_davies_bouldin": lambda s, d: t.comparable(metrics.davies_bouldin(labelled(s, d), "label", FINAL)),
    "i9_calinski_harabasz": lambda s, d: t.comparable(metrics.calinski_harabasz(vectors(s, d), "label", VECTOR)),
    "i9_customer_calinski_harabasz": lambda s, d: t.comparable(metrics.calinski_harabasz(labelled(s, d), "label", FINAL)),
    "e1_elbow": lambda s, d: t.comparable(metrics.elbow(label_sweep(s, d))),
    "e2_best_silhouette": best_k,
    "b20_without_noise": without_noise,
    "d25_clusters_without_noise": clusters_without_noise,
    "i12_given_projection": given_projection,
    "i3_kmeans": kmeans_clusters,
    "i3_best_fit": best_fit,
    "i10_sweep": kmeans_sweep,
    "i10_drawn_sweep": drawn_sweep,
    "i11_pca": pca_coordinates,
    "i11_loadings": pca_loadings,
    "i14_core_points": core_flags,
    "i14_density_clusters": density_clusters,
    "i15_ward_clusters": ward_clusters,
    "i15_ward_heights": ward_heights,
    "i15_full_ward": full_ward,
    "i16_given_algorithms": given_algorithms,
    "i16_compare_algorithms": algorithms,
}

SCALED = scaled_sql(t.FEATURES_SQL)
LABELLED = (
    SCALED
    + f""", lab AS (SELECT scaled.*, CAST(list_position({t.MARKETS!r}, c_mktsegment) - 1 AS INTEGER) AS label
  FROM scaled JOIN customer ON c_custkey = "CustomerID")"""
)
_X = "[" + ", ".join(f'"{c}"' for c in FINAL) + "]"
_POINTS = LABELLED + f', pts AS (SELECT "CustomerID" AS id, label, CAST({_X} AS DOUBLE[]) AS x FROM lab)'
_VECTORS = "pts AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"


def centres_sql(points: str, dims: int) -> str:
    means = "[" + ", ".join(f"avg(x[{i + 1}])" for i in range(dims)) + "]"
    return f"{points}, cen AS (SELECT label, count(*) AS n, {means} AS c FROM pts GROUP BY label)"


_DIST = "list_distance(x, c)"


def _inertia(points, dims):
    return f"""WITH {centres_sql(points, dims)} SELECT {r(f'sum({_DIST} * {_DIST})')} AS inertia FROM pts JOIN cen USING (label)"""


def _davies(points, dims, digits=4):
    return f"""WITH {centres_sql(points, dims)}, s AS (SELECT label, any_value(c) AS c, avg({_DIST}) AS spread FROM pts JOIN cen USING (label) GROUP BY label),
worst AS (SELECT a.label, max((a.spread + b.spread) / list_distance(a.c, b.c)) AS w FROM s a JOIN s b ON a.label <> b.label GROUP BY a.label)
SELECT {r('avg(w)', digits)} AS davies_bouldin FROM worst"""


def _calinski(points, dims):
    mean = "[" + ", ".join(f"avg(x[{i + 1}])" for i in range(dims)) + "]"
    return f"""WITH {centres_sql(points, dims)}, m AS (SELECT {mean} AS m FROM pts),
b AS (SELECT sum(n * list_distance(c, m) ** 2) AS b, count(*) AS k, sum(n) AS n FROM cen, m), w AS (SELECT sum({_DIST} ** 2) AS w FROM pts JOIN cen USING (label))
SELECT {r('b * (n - k) / (w * (k - 1))')} AS calinski_harabasz FROM b, w"""


def silhouette_sql(points: str, labelling: str, digits: int = 6) -> str:
    return f"""WITH {points}, sz AS (SELECT label, count(*) AS n FROM pts GROUP BY label),
d AS (SELECT p.id, p.label AS own, q.label AS other, sum(list_distance(p.x, q.x)) AS s FROM pts p, pts q GROUP BY p.id, p.label, q.label),
ab AS (SELECT id, any_value(own) AS own, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
  min(CASE WHEN own <> other THEN s / n END) AS b FROM d JOIN sz ON other = sz.label GROUP BY id)
SELECT '{labelling}' AS labelling, (SELECT count(*) FROM sz) AS n_clusters, count(*) AS n,
  {r('avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)', digits)} AS silhouette FROM ab"""


def _folded(k):
    return f"pts AS (SELECT vec_id AS id, CAST(floor(label * {k} / 10) AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"


def _per_k(make) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({make(k)})" for k in range(2, 7))


_INERTIAS = _per_k(lambda k: f"WITH {centres_sql(_folded(k), 64)} SELECT {k} AS k, sum({_DIST} * {_DIST}) AS inertia FROM pts JOIN cen USING (label)")
_SILHOUETTES = _per_k(lambda k: f"SELECT *, CAST({k} AS BIGINT) AS k FROM ({silhouette_sql(_folded(k), f'k{k}')})")
_NOISE = LABELLED + """, noisy AS (SELECT "CustomerID", CAST(CASE WHEN label = 4 THEN -1 ELSE label END AS BIGINT) AS label FROM lab)"""
_TO = ", ".join(r(f"list_distance(x, (SELECT c FROM cen WHERE label = {i}))") + f" AS to_{i}" for i in range(5))

_NEAR = _POINTS + """, near AS (SELECT a.id AS a, b.id AS b FROM pts a, pts b WHERE list_distance(a.x, b.x) <= 0.5),
cores AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5)"""

ORACLES = {
    "i3_kmeans": f"""WITH RECURSIVE {SCALED}, {fits.PTS}, {fits.lloyd_sql(4)} SELECT CAST(cen.label AS BIGINT) AS "Cluster", count(id) AS n,
  {r('(SELECT sum(d * d) FROM fitted)')} AS inertia, {", ".join(r(f"any_value(c)[{i + 1}]") + f' AS "{c}"' for i, c in enumerate(FINAL))}
  FROM cen LEFT JOIN fitted ON fitted.label = cen.label GROUP BY cen.label""",
    "i3_best_fit": f"""WITH {SCALED} SELECT CAST(count(*) AS BIGINT) AS customers, CAST(4 AS BIGINT) AS clusters,
  true AS centres_are_means, true AS inertia_is_sum, true AS at_most_given FROM scaled""",
    "i10_sweep": " UNION ALL ".join(
        f"SELECT * FROM (WITH RECURSIVE {SCALED}, {fits.PTS}, {fits.lloyd_sql(k)}, {fits.measures_sql(k)} SELECT * FROM measured)" for k in range(2, 11)
    ),
    "i11_pca": f"""WITH RECURSIVE {SCALED}, {fits.PTS}, {fits.pca_sql(3)} SELECT id AS "CustomerID", {fits.PCA_COLUMNS} FROM pts""",
    "i11_loadings": f"""WITH RECURSIVE {SCALED}, {fits.pca_sql(3)} SELECT CAST(component AS BIGINT) AS component, {r('variance / total')} AS explained,
  {", ".join(r(f"v[{i + 1}]") + f' AS "{c}"' for i, c in enumerate(FINAL))} FROM loadings""",
    "i4_nearest_centre": f"""WITH {centres_sql(_POINTS, 6)}, d AS (SELECT id, cen.label, {_DIST} AS d FROM pts, cen)
SELECT id AS "CustomerID", CAST(arg_min(label, d) AS BIGINT) AS "Cluster", {r('min(d)')} AS "Distance_to_Center" FROM d GROUP BY id""",
    "i5_distances": f"""WITH {centres_sql(_POINTS, 6)} SELECT id AS "CustomerID", {_TO} FROM pts""",
    "i6_inertia": _inertia(_VECTORS, 64),
    "i6_customer_inertia": _inertia(_POINTS, 6),
    "i7_silhouette": silhouette_sql(_VECTORS, "label"),
    "i7_customer_silhouette": silhouette_sql(_POINTS, "label"),
    "i7_silhouette_sweep": _SILHOUETTES,
    "i7_squared_silhouette": silhouette_sql(_POINTS, "label").replace("list_distance(p.x, q.x)", "list_distance(p.x, q.x) ** 2").replace(
        "AS silhouette", "AS squared_silhouette"
    ),
    "i8_davies_bouldin": _davies(_VECTORS, 64, 6),
    "i8_customer_davies_bouldin": _davies(_POINTS, 6),
    "i9_calinski_harabasz": _calinski(_VECTORS, 64),
    "i9_customer_calinski_harabasz": _calinski(_POINTS, 6),
    "e1_elbow": f"""WITH s AS ({_INERTIAS}), f AS (SELECT k, (inertia - lag(inertia) OVER (ORDER BY k)) / lag(inertia) OVER (ORDER BY k) AS fall FROM s),
g AS (SELECT k, fall, lag(fall) OVER (ORDER BY k) AS before FROM f)
SELECT CAST(coalesce(min(k - 1), 4) AS BIGINT) AS elbow_k FROM g WHERE before IS NOT NULL AND fall > 0.7 * before""",
    "e2_best_silhouette": f"""SELECT CAST(k AS BIGINT) AS best_silhouette_k FROM ({_SILHOUETTES}) ORDER BY silhouette DESC, k LIMIT 1""",
    "b20_without_noise": f'WITH {_NOISE} SELECT "CustomerID", label FROM noisy WHERE label <> -1',
    "d25_clusters_without_noise": f"""WITH {_NOISE} SELECT count(DISTINCT label) FILTER (label <> -1) AS n_clusters,
  count(*) FILTER (label = -1) AS n_noise FROM noisy""",
    "i14_core_points": f"""WITH {_NEAR} SELECT id AS "CustomerID", id IN (SELECT id FROM cores) AS is_core FROM pts""",
    "i14_density_clusters": f"""WITH RECURSIVE {_NEAR}, links AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM cores) AND b IN (SELECT id FROM cores)),
reach AS (SELECT id, id AS root FROM cores UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.id WHERE reach.root < links.b),
roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS c FROM roots),
border AS (SELECT a AS id, min(c) AS c FROM near JOIN numbered ON b = numbered.id WHERE a NOT IN (SELECT id FROM cores) GROUP BY a)
SELECT pts.id AS "CustomerID", CAST(coalesce(numbered.c, border.c, -1) AS BIGINT) AS "Cluster" FROM pts
  LEFT JOIN numbered ON pts.id = numbered.id LEFT JOIN border ON pts.id = border.id""",
    "i12_given_projection": f"""WITH {SCALED} SELECT "CustomerID", {", ".join(
        r(" + ".join(f'"{c}" * {w}' for c, w in zip(FINAL, loading))) + f' AS "PCA{i}_2D"' for i, loading in enumerate(GIVEN_LOADINGS, 1))}
  FROM scaled""",
}

_DENSE = f"""WITH {SCALED}, {fits.PTS}, lab AS ({ORACLES["i14_density_clusters"]}),
kept AS (SELECT id, x, "Cluster" AS label FROM pts JOIN lab ON id = "CustomerID" WHERE "Cluster" <> -1),
sz AS (SELECT label, count(*) AS n FROM kept GROUP BY label),
far AS (SELECT p.id, p.label AS own, q.label AS other, sum(list_distance(p.x, q.x)) AS s FROM kept p, kept q GROUP BY p.id, p.label, q.label),
ab AS (SELECT id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b
  FROM far JOIN sz ON other = sz.label GROUP BY id)
SELECT 'DBSCAN' AS algorithm, (SELECT count(*) FROM sz) AS n_clusters,
  CASE WHEN (SELECT count(*) FROM sz) > 1 THEN {r("(SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) FROM ab)", 6)} END AS silhouette,
  CAST(NULL AS VARCHAR) AS error, (SELECT count(*) FROM pts) AS customers"""

ORACLES["i16_given_algorithms"] = f"""SELECT * FROM (WITH RECURSIVE {SCALED}, {fits.PTS}, {fits.lloyd_sql(4)}, {fits.measures_sql(4)}
SELECT 'KMeans' AS algorithm, (SELECT count(DISTINCT label) FROM fitted) AS n_clusters, silhouette, CAST(NULL AS VARCHAR) AS error,
  (SELECT count(*) FROM fitted) AS customers FROM measured) UNION ALL SELECT * FROM ({_DENSE})"""

# Cells of the finest of the grids that has few enough, then one merge at a time of the cheapest pair.
_LOW = "[" + ", ".join(f'min("{c}")' for c in FINAL) + "]"
_HIGH = "[" + ", ".join(f'max("{c}")' for c in FINAL) + "]"
_CELL = """list_transform(range(1, 7), lambda i: least(floor((x[i] - low[i]) / CASE WHEN high[i] = low[i] THEN 1 ELSE high[i] - low[i] END
  * (1::BIGINT << h) + 1e-9), (1::BIGINT << h) - 1))"""
_PAIRS = """flatten(list_transform(range(1, len(s)), lambda i: list_transform(range(i + 1, len(s) + 1), lambda j: struct_pack(
  cost := s[i].n * s[j].n / (s[i].n + s[j].n) * list_distance(s[i].c, s[j].c) ** 2, i := i, j := j))))"""
_WARD = f"""WITH RECURSIVE {SCALED}, {fits.PTS}, ends AS (SELECT CAST({_LOW} AS DOUBLE[]) AS low, CAST({_HIGH} AS DOUBLE[]) AS high FROM scaled),
placed AS (SELECT id, x, h, {_CELL} AS cell FROM pts, ends, range(0, 25) AS hs(h)),
few AS (SELECT max(h) AS h FROM (SELECT h FROM placed GROUP BY h HAVING count(DISTINCT cell) <= {SUMMARIES})),
cells AS MATERIALIZED (SELECT cell, count(*)::DOUBLE AS n, [{", ".join(f"avg(x[{i}])" for i in range(1, 7))}] AS c, row_number() OVER (ORDER BY cell) AS m
  FROM placed WHERE h = (SELECT h FROM few) GROUP BY cell),
w AS (SELECT 0 AS step, list(struct_pack(n := n, c := c, m := [m]) ORDER BY m) AS s, 0e0 AS height, 0e0 AS points FROM cells UNION ALL
  SELECT step + 1, list_append(list_filter(s, lambda v: v.m <> a.m AND v.m <> b.m), struct_pack(n := a.n + b.n,
      c := list_transform(range(1, 7), lambda i: (a.c[i] * a.n + b.c[i] * b.n) / (a.n + b.n)), m := list_concat(a.m, b.m))), sqrt(2 * cost), a.n + b.n
  FROM (SELECT step, s, s[p.i] AS a, s[p.j] AS b, p.cost AS cost FROM (SELECT step, s, list_min({_PAIRS}) AS p FROM w WHERE len(s) > 1)))"""
ORACLES["i15_ward_clusters"] = f"""{_WARD}, four AS (SELECT unnest(s) AS v FROM w WHERE len(s) = 4),
numbered AS (SELECT unnest(v.m) AS m, dense_rank() OVER (ORDER BY list_min(v.m)) - 1 AS "Cluster" FROM four)
SELECT id AS "CustomerID", "Cluster" FROM placed JOIN cells ON cells.cell = placed.cell JOIN numbered ON numbered.m = cells.m WHERE h = (SELECT h FROM few)"""
ORACLES["i15_ward_heights"] = f"""{_WARD} SELECT CAST(step - 1 AS BIGINT) AS step, {r('height')} AS height, CAST(points AS BIGINT) AS points FROM w WHERE step > 0"""
