"""Fits from given starting centres, in Spark and as recursive SQL: Lloyd's passes, principal components, trained scores.

With the starting centres and the number of passes given, every engine gets the same centres, so whole rows compare.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import tables as t
from checks.customers import FINAL, SCORING_SQL, scaled_sql
from checks.tables import r
from tallybasket.operators import segments

#: Passes of every fit from given centres. Fits that have come to rest earlier stay where they are in both engines.
PASSES = 12
GIVEN = {"max_iter": PASSES, "tol": 0.0}
_N = len(FINAL)


def starts(rows, cols, k):
    """Means of the customers by the remainder of their id: k starting centres."""
    means = rows.groupBy((F.col("CustomerID") % k).alias("g")).agg(*[F.avg(c).alias(c) for c in cols]).orderBy("g")
    return [[row[c] for c in cols] for row in means.collect()]


SCALED = scaled_sql(t.FEATURES_SQL)
_X = "[" + ", ".join(f'"{c}"' for c in FINAL) + "]"
PTS = f'pts AS MATERIALIZED (SELECT "CustomerID" AS id, CAST({_X} AS DOUBLE[]) AS x FROM scaled)'
_MEANS = "[" + ", ".join(f"avg(x[{i + 1}])" for i in range(_N)) + "]"


def lloyd_sql(k: int) -> str:
    """CTEs ``cen`` (label, c) and ``fitted`` (id, x, label, d) over ``pts``."""
    return f"""start AS (SELECT list(c ORDER BY g) AS cs FROM (SELECT id % {k} AS g, {_MEANS} AS c FROM pts GROUP BY 1)),
lloyd AS (SELECT 0 AS i, cs FROM start UNION ALL SELECT i + 1, list(c ORDER BY label) FROM (
  SELECT i, label, {_MEANS} AS c FROM (SELECT i, x, list_position(ds, list_min(ds)) AS label FROM (
    SELECT i, x, list_transform(cs, lambda c: list_distance(x, c)) AS ds FROM lloyd, pts WHERE i < {PASSES})) GROUP BY i, label) GROUP BY i),
cen AS MATERIALIZED (SELECT unnest(range(len(cs))) AS label, unnest(cs) AS c FROM (SELECT cs FROM lloyd ORDER BY i DESC LIMIT 1)),
fitted AS MATERIALIZED (SELECT id, any_value(x) AS x, arg_min(label, list_distance(x, c)) AS label, min(list_distance(x, c)) AS d FROM pts, cen GROUP BY id)"""


def measures_sql(k: int) -> str:
    """CTE ``measured``: inertia, silhouette, davies_bouldin and calinski_harabasz of ``fitted``, as one row."""
    return f"""own AS (SELECT label, count(*) AS n, {_MEANS} AS c FROM fitted GROUP BY label),
far AS (SELECT p.id, p.label AS own, q.label AS other, sum(list_distance(p.x, q.x)) AS s FROM fitted p, fitted q GROUP BY p.id, p.label, q.label),
ab AS (SELECT id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b
  FROM far JOIN own ON other = own.label GROUP BY id),
spread AS (SELECT fitted.label, any_value(c) AS c, any_value(n) AS n, avg(list_distance(x, c)) AS e, sum(list_distance(x, c) ** 2) AS w
  FROM fitted JOIN own ON own.label = fitted.label GROUP BY fitted.label),
worst AS (SELECT a.label, max((a.e + b.e) / list_distance(a.c, b.c)) AS w FROM spread a JOIN spread b ON a.label <> b.label GROUP BY a.label),
middle AS (SELECT {_MEANS} AS m FROM fitted),
between_within AS (SELECT sum(n * list_distance(c, m) ** 2) AS b, sum(w) AS w, count(*) AS k, sum(n) AS n FROM spread, middle),
measured AS (SELECT CAST({k} AS BIGINT) AS k, {r('(SELECT sum(d * d) FROM fitted)')} AS inertia,
  {r('(SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) FROM ab)', 6)} AS silhouette,
  {r('(SELECT avg(w) FROM worst)', 6)} AS davies_bouldin, {r('b * (n - k) / (w * (k - 1))', 3)} AS calinski_harabasz FROM between_within)"""


def _matrix(make) -> str:
    return f"list_transform(range(1, {_N + 1}), lambda i: list_transform(range(1, {_N + 1}), lambda j: {make}))"


def pca_sql(n: int) -> str:
    """CTE ``loadings`` (component, v, variance, total) of the first n principal components of ``scaled``.

    Squaring the covariance matrix again and again leaves the first component alone; taking it off gives the next.
    """
    cov = "[" + ", ".join("[" + ", ".join(f'covar_samp("{a}", "{b}")' for b in FINAL) + "]" for a in FINAL) + "]"
    trace = f"list_sum(list_transform(range(1, {_N + 1}), lambda i: m[i][i]))"
    out = [f"m1 AS (SELECT {cov} AS m FROM scaled)"]
    for c in range(1, n + 1):
        square = _matrix(f"list_sum(list_transform(range(1, {_N + 1}), lambda k: m[i][k] * m[k][j]))")
        out.append(f"""q{c} AS (SELECT 0 AS step, {_matrix(f'm[i][j] / ({trace})')} AS m FROM m{c} UNION ALL
  SELECT step + 1, {_matrix(f'm[i][j] / ({trace})')} FROM (SELECT step, {square} AS m FROM q{c} WHERE step < 50)),
d{c} AS (SELECT m, list_transform(range(1, {_N + 1}), lambda i: m[i][i]) AS d FROM q{c} ORDER BY step DESC LIMIT 1),
u{c} AS (SELECT list_transform(range(1, {_N + 1}), lambda i: m[i][list_position(d, list_max(d))] / sqrt(list_max(d))) AS u FROM d{c}),
a{c} AS (SELECT u, list_transform(u, lambda y: abs(y)) AS size FROM u{c}),
v{c} AS (SELECT list_transform(u, lambda y: y * sign(u[list_position(size, list_max(size))])) AS v FROM a{c}),
l{c} AS (SELECT v, m, list_inner_product(v, list_transform(m, lambda row: list_inner_product(CAST(row AS DOUBLE[]), v))) AS l FROM v{c}, m{c}),
m{c + 1} AS (SELECT {_matrix('m[i][j] - l * v[i] * v[j]')} AS m FROM l{c})""")
    rows = " UNION ALL ".join(f"SELECT {c} AS component, v, l AS variance, (SELECT {trace} FROM m1) AS total FROM l{c}" for c in range(1, n + 1))
    return ", ".join(out) + f", loadings AS MATERIALIZED ({rows})"


def _pick(c: int) -> str:
    return f"list_inner_product(x, (SELECT v FROM loadings WHERE component = {c}))"


#: Coordinates of ``x`` in two and in three dimensions.
PCA_COLUMNS = ", ".join([r(_pick(c)) + f' AS "PCA{c}_2D"' for c in (1, 2)] + [r(_pick(c)) + f' AS "PCA{c}_3D"' for c in (1, 2, 3)])

#: The training job with four given centres: ``trained`` (id, x, d, Cluster by spend) and ``tcen`` (Cluster, c).
TRAINED = f"""WITH RECURSIVE {SCALED}, {PTS}, {lloyd_sql(4)},
ranked AS (SELECT label, row_number() OVER (ORDER BY avg("Monetary") DESC, label) - 1 AS "Cluster"
  FROM fitted JOIN feat ON id = "CustomerID" GROUP BY label),
trained AS MATERIALIZED (SELECT id, x, d, "Cluster" FROM fitted JOIN ranked ON ranked.label = fitted.label),
tcen AS (SELECT "Cluster", c FROM cen JOIN ranked ON ranked.label = cen.label)"""

_SCORED = ", ".join(
    f'("{c}" - (SELECT avg("{c}") FROM matrix)) / (SELECT CASE WHEN stddev_pop("{c}") = 0 THEN 1 ELSE stddev_pop("{c}") END FROM matrix) AS "{c}"'
    for c in FINAL
)
_NAMES = 'CASE "Cluster" ' + " ".join(f"WHEN {i} THEN '{row[1]}'" for i, row in enumerate(segments.SEGMENTS)) + " END"
#: All events scored by the trained model: ``scored`` (CustomerID, x, features, Cluster, d, name).
TRAINED_SCORES = f"""{TRAINED}, {pca_sql(3)}, {SCORING_SQL}, inputs AS (SELECT "CustomerID", CAST("Recency" AS DOUBLE) AS "Recency",
  ln(1 + "Frequency") AS "Log_Frequency", ln(1 + "Monetary") AS "Log_Monetary", ln(1 + "AvgTransactionValue") AS "Log_AvgTransactionValue",
  CAST("CustomerLifetime" AS DOUBLE) AS "CustomerLifetime", "PurchaseFrequency" FROM sfeat),
z AS (SELECT "CustomerID", {_SCORED} FROM inputs), zx AS (SELECT *, CAST({_X} AS DOUBLE[]) AS x FROM z),
near AS (SELECT "CustomerID", arg_min("Cluster", list_distance(x, c)) AS "Cluster", min(list_distance(x, c)) AS d FROM zx, tcen GROUP BY "CustomerID"),
scored AS (SELECT zx.*, "Cluster", d, {_NAMES} AS name FROM zx JOIN near ON near."CustomerID" = zx."CustomerID")"""
SCORE_CORE = f'"CustomerID", "Cluster" AS "Segment", name AS "Segment_Name", {r("d")} AS "Distance_to_Center"'
SCORE_FEATURES = ", ".join(r(f'"{c}"') + f' AS "Feature_{c}"' for c in FINAL)
CENTRE_COLUMNS = ", ".join(r(f"c[{i + 1}]") + f' AS "{c}"' for i, c in enumerate(FINAL))
