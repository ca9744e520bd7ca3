"""The registered queries ``opN_<name>`` on whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybasket.llm import (
    bpe,
    collocations,
    debruijn_dedup,
    divergence,
    html_text,
    mixing,
    quality_model,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    top_k,
    url_rules,
)
from tallybasket.llm.common import table


#: The words of every window of 20 as one text; windows after the first of their kind cover what goes.
OP1_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS n, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS size FROM d),
v AS (SELECT *, CASE WHEN i + 19 <= size THEN string_agg(word, ' ') OVER
        (PARTITION BY n ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) END AS win FROM t),
r AS (SELECT *, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS later FROM v),
g AS (SELECT *, bool_or(later) OVER (PARTITION BY n ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
k AS (SELECT n, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM g GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (n)"""


def vocabulary() -> str:
    """Path of the given byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return debruijn_dedup.remove_repeats(docs, words=20, keep_text=False).drop("removed")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.cycling_weights(docs))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


#: The same draw, histogram cells and thresholds, with the level found by sorting sources by cap over weight.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(1114111)) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 10) AS BIGINT) AS draw
  FROM documents),
s AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY k),
w AS (SELECT k, source_size, CAST(list_element([5, 2, 1], CAST((row_number() OVER (ORDER BY k COLLATE C) - 1) % 3 + 1 AS INTEGER)) AS DOUBLE) AS weight,
             1.5 * (SELECT sum(source_size) FROM s) AS total FROM s),
o AS (SELECT *, coalesce(sum(2.0 * source_size) OVER p, 0) AS caps, sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS open
      FROM w WINDOW p AS (ORDER BY source_size / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT CAST(total AS DOUBLE) - caps AS rest, open FROM o WHERE weight * (CAST(total AS DOUBLE) - caps) / open <= 2.0 * source_size
      ORDER BY source_size / weight, k LIMIT 1),
t AS (SELECT k, source_size, least(weight * (SELECT rest FROM l) / (SELECT open FROM l), 2.0 * source_size) AS target FROM w),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
e AS (SELECT *, target - whole * source_size AS extra FROM p),
c AS (SELECT k, draw >> 20 AS cell, sum(size) AS size FROM d GROUP BY ALL),
r AS (SELECT k, cell, size, sum(size) OVER (PARTITION BY k ORDER BY cell) AS upto,
             sum(size) OVER (PARTITION BY k ORDER BY cell >> 10 RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto_high FROM c),
g AS (SELECT k, min(cell >> 10) AS high FROM r JOIN e USING (k) WHERE upto_high > extra GROUP BY k),
b AS (SELECT k, min(CASE WHEN NOT (upto <= extra OR abs(upto - extra) < abs(upto - size - extra)) THEN cell END) AS cell,
             max((cell >> 10) * 1024 + 1024) AS end_cell
      FROM r JOIN e USING (k) JOIN g USING (k) WHERE cell >> 10 = high GROUP BY k),
n AS (SELECT e.*, CASE WHEN extra <= 0 THEN 0 ELSE coalesce(coalesce(b.cell, b.end_cell) << 20, 1099511627776) END AS below
      FROM e LEFT JOIN b USING (k))
SELECT doc_id, size, source_size, target, size * CAST(whole + CASE WHEN draw < below THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM d JOIN n USING (k)"""


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_dedup.remove_repeats(docs, length=100, keep_text=False).drop("removed", "was_null")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20, factor=64.0)


OP6_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), vocabulary(), keep_ids=False)


#: Host, path and verdict (fixed values of the query).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


OP8_SQL = r"""
WITH rules(h, p, v) AS (VALUES """ + ", ".join(map(str, URL_RULES)) + r"""),
u AS (SELECT page_id, row_number() OVER () AS n,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
m AS (SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
      FROM u JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m USING (n)"""


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)
    return groups.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=16)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), min_count=100, max_words=5, top=2000)


OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
totals AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM w, range(1, 6) AS sizes(size)),
f AS (SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
s AS (SELECT *, string_split(phrase, ' ') AS ws FROM f),
c AS (SELECT lang, size, phrase, ws, a, unnest(range(1, size)) AS k FROM s WHERE size > 1),
m AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, n,
        CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1 : k], ' ')
             JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1 : c.size], ' ')
             JOIN totals ON totals.lang = c.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM m),
u AS (SELECT lang, size, a, ws, unnest(range(1, size)) AS i FROM s WHERE size > 2),
v AS (SELECT lang, a, ws, i, unnest(range(i + 1, size + 1)) AS j, size FROM u),
around AS (SELECT lang, array_to_string(ws[i : j], ' ') AS phrase, max(a) AS around FROM v WHERE j - i + 1 < size GROUP BY ALL),
t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
      FROM b LEFT JOIN around ON around.lang = b.lang AND around.phrase = b.phrase WHERE cut = 1 AND (around IS NULL OR 100 * around < 100 * a))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM t WHERE rank <= 2000"""


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"), min_docs=10, top=10)


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 10),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS c FROM w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, total, coalesce(c, 0) AS c,
        1 + CAST(CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 2) // (coalesce(n.n, 0) + 2 * v.v) AS BIGINT) AS p,
        1 + CAST(CAST(1000000000 AS HUGEINT) * (total + 2) // (v.n + 2 * v.v) AS BIGINT) AS q
      FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
             LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE c > 0 AND p > q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 10"""


QUERIES = {
    "op1_debruijn_dedup": op1_debruijn_dedup,
    "op2_html_text": op2_html_text,
    "op3_quality_rules": op3_quality_rules,
    "op4_mix_sources": op4_mix_sources,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_top_k": op6_top_k,
    "op7_bpe": op7_bpe,
    "op8_url_rules": op8_url_rules,
    "op9_quality_model": op9_quality_model,
    "op10_simhash": op10_simhash,
    "op11_sharding": op11_sharding,
    "op12_collocations": op12_collocations,
    "op13_divergence": op13_divergence,
}
ORACLES = {
    "op1_debruijn_dedup": OP1_SQL,
    "op4_mix_sources": OP4_SQL,
    "op6_top_k": OP6_SQL,
    "op8_url_rules": OP8_SQL,
    "op12_collocations": OP12_SQL,
    "op13_divergence": OP13_SQL,
}
