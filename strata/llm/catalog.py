"""Registered queries of the corpus operators, with their SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import language_id
from strata.llm.collocations import collocations
from strata.llm.common import load
from strata.llm.decontaminate import contaminated, overlaps
from strata.llm.fill_in_middle import fill_in_middle, restore
from strata.llm.jaccard_join import jaccard_join
from strata.llm.line_dedup import line_dedup
from strata.llm.mixing import mix
from strata.llm.path_join import path_join
from strata.llm.secret_scan import scan, train, written
from strata.llm.sharding import shard_documents
from strata.llm.topk_search import topk
from strata.llm.url_filter import url_filter
from strata.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@_register("op2_line_dedup", r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id
""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(load(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@_register("op3_topk_search", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
""")
def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk(load(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10)


@_register("op10_decontaminate", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
m AS (SELECT DISTINCT least(13, len(w)) AS m FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT d.*, m.m, unnest(range(1, len(w) - m.m + 2)) AS i FROM d, m WHERE len(w) >= m.m)),
h AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (m, g)),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(xs, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
""")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = overlaps(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), window=13, k=7)
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


@_register("op4_warc", """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h),
c AS (SELECT h, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1), '' ORDER BY i) AS b32
  FROM (SELECT h, unnest(range(32)) AS i FROM g) GROUP BY h)
SELECT page_id, n AS payload_bytes, b32 AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN g USING (h) JOIN c USING (h)
""")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(load(spark, sf_dir, "pages"), min_revisit_bytes=0)


@_register("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    out = scan(docs, train(docs), min_chars=20, min_bits=1.0)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        F.col("id").alias("doc_id"), of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))


@_register("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    out = language_id.predict(docs, language_id.train(docs))
    return out.select("kept.doc_id", language_id.held_out(F.col("kept.doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


@_register("op1_source_mix")
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents"), block=8, period=200, max_share=0.2).select("kept.doc_id", "mix.*")


@_register("op8_shards")
def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(load(spark, sf_dir, "documents"), shards=8)
    return out.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


@_register("op6_jaccard_join", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (WITH RECURSIVE r(id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.id, e.b FROM r JOIN e ON r.c = e.a) SELECT * FROM r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = d.doc_id
""")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join(load(spark, sf_dir, "documents"), k=5, percent=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@_register("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return url_filter(load(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


@_register("op11_path_join", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (WITH RECURSIVE r(id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.id, e.b FROM r JOIN e ON r.c = e.a) SELECT * FROM r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = d.doc_id
""")
def op11_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = path_join(load(spark, sf_dir, "documents"), k=5, percent=85)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


@_register("op12_fill_in_middle", r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us FROM documents),
d AS (SELECT *, len(us) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(us[1 : lo], '') AS pre, array_to_string(us[lo + 1 : hi], '') AS mid, array_to_string(us[hi + 1 : n], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
""")
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(load(spark, sf_dir, "documents"), seed=42, fim_percent=50, spm_percent=80)
    return out.select("kept.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@_register("op13_collocations", r"""
WITH p AS (SELECT row_number() OVER () AS pid, lang, piece FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents)),
w AS (SELECT pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, w[i : i + m - 1] AS g FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, g, count(*) AS a FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE m > 1 AND a >= 30),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.g, k.m, k.a, k.k, l.a AS l, r.a AS r, CAST((2000000::HUGEINT * k.a) // (l.a + r.a) AS BIGINT) AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.m = k.k AND l.g = k.g[1 : k.k] JOIN f r ON r.lang = k.lang AND r.m = k.m - k.k AND r.g = k.g[k.k + 1 : k.m]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
i AS (SELECT lang, a, m AS of_m, g, m2 AS m, unnest(range(1, m - m2 + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m2) WHERE m2 < m),
o AS (SELECT lang, g[i : i + m - 1] AS g, max(a) AS cover FROM i GROUP BY ALL),
x AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.a, b.l, b.r, b.score FROM b LEFT JOIN o ON o.lang = b.lang AND o.g = b.g
  WHERE o.cover IS NULL OR 100::HUGEINT * o.cover < 80::HUGEINT * b.a),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM x)
SELECT z.lang, rank, phrase, a, l, r, t.n, score FROM z JOIN t ON t.lang = z.lang WHERE rank <= 2000
""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(load(spark, sf_dir, "documents"), min_count=30, longest=4, top=2000)


@_register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
