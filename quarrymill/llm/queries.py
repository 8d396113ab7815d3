"""The registered queries of the dealt operators and their SQL, one opN_ query for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_trie, decontamination, filter_audit, fingerprints, jaccard_join, line_dedup, packing, quality, secrets, surrogates, topk, toxicity, url_reputation
from .common import id_remainder

# Fixed rules of the url query.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]

#: The registered query's key; a caller passes a secret of its own.
SURROGATE_KEY = "quarrymill-demo-key"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.benchmark_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    scored = quality.quality_scores(docs, labels, id_remainder("doc_id", 3) != 1)
    return scored.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_read(spark, sf_dir, "documents"))


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return url_reputation.url_verdicts(pages, URL_RULES, url_reputation.page_outcome(F.col("html")))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.replace_entities(_read(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.select("doc_id", "text", "n_entities", "kinds")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_confirmed")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, id_remainder("doc_id", 5) != 0)
    scored = toxicity.score_texts(docs, model, ["doc_id"])
    return scored.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.shared_opening_trie(_read(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_read(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_url_reputation": op4_url_reputation,
    "op5_surrogates": op5_surrogates,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_secrets": op8_secrets,
    "op9_topk": op9_topk,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_filter_audit": op13_filter_audit,
}

TOPK_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM good q JOIN good d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
"""

# The same estimates as url_reputation's, level by level.
URL_SQL = r"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    regexp_replace(html, '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<[^>]*>|&[a-z]+;', ' ', 'g') AS seen FROM pages
), o AS (
  SELECT *, length(seen) - length(translate(seen, '$%*#!|', '')) AS junk, length(seen) AS size FROM p
), h0 AS (
  SELECT host, count(CASE WHEN size > 0 THEN 1 END) AS n, coalesce(sum(CASE WHEN size > 0 AND junk > 0.03 * size THEN 1 ELSE 0 END), 0)::DOUBLE AS bad FROM o GROUP BY host
), h AS (
  SELECT *, list_reverse(string_split(host, '.')) AS parts FROM h0
), hd AS (
  SELECT host, n, bad, parts[1] AS suffix, CASE WHEN len(parts) > 1 THEN parts[2] || '.' || parts[1] ELSE parts[1] END AS domain FROM h
), d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hd GROUP BY ALL
), s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL
), t AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM hd
), sm AS (SELECT s.*, greatest(least(t.m, 1 - 1e-6), 1e-6) AS m FROM s, t
), sr AS (SELECT 1 / least(greatest(coalesce((sum(n * pow(bad / n - m, 2) / (m * (1 - m))) - count(*)) / nullif(sum(n) - count(*), 0), 0), 1e-3), 0.9) - 1 AS k FROM sm WHERE n > 0
), sp AS (SELECT suffix, (m * k + bad) / (k + n) AS p FROM sm, sr
), dm AS (SELECT d.*, greatest(least(sp.p, 1 - 1e-6), 1e-6) AS m FROM d JOIN sp USING (suffix)
), dr AS (SELECT 1 / least(greatest(coalesce((sum(n * pow(bad / n - m, 2) / (m * (1 - m))) - count(*)) / nullif(sum(n) - count(*), 0), 0), 1e-3), 0.9) - 1 AS k FROM dm WHERE n > 0
), dp AS (SELECT domain, (m * k + bad) / (k + n) AS p FROM dm, dr
), hm AS (SELECT hd.*, greatest(least(dp.p, 1 - 1e-6), 1e-6) AS m FROM hd JOIN dp USING (domain)
), hr AS (SELECT 1 / least(greatest(coalesce((sum(n * pow(bad / n - m, 2) / (m * (1 - m))) - count(*)) / nullif(sum(n) - count(*), 0), 0), 1e-3), 0.9) - 1 AS k FROM hm WHERE n > 0
), hp AS (SELECT host, m * k + bad AS a, (1 - m) * k + n - bad AS b FROM hm, hr
), f AS (
  SELECT host, a / (a + b) AS p, greatest(a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0) AS low FROM hp
), r AS (
  SELECT p.page_id, p.host, p.path, f.p, f.low, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM p JOIN f USING (host)
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN low > 0.1 THEN 'block' ELSE 'allow' END AS verdict,
  round(p, 6) AS bad_rate, round(low, 6) AS bad_low FROM r
"""

# crc32 bit by bit: a byte is XORed in, then eight shifts (-1 in the list).
TRIE_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, text, md5(coalesce(length(role), 0) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list({'id': id, 'size': size} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id
), h AS (
  SELECT *, conv_id - conv_id % 100 AS base, (xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''),
    lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 6)::INT AS h FROM c
), r AS (
  SELECT h.conv_id, coalesce(b.turns[1:h.h], []) || h.turns[h.h + 1:len(h.turns)] AS turns FROM h LEFT JOIN c b ON b.conv_id = h.base
), p AS (
  SELECT conv_id, len(turns) AS size_all, d AS depth, list_transform(turns[1:d], lambda x: x.id) AS key, CASE WHEN d > 0 THEN turns[d].size ELSE 0 END AS size FROM r, unnest(range(0, len(turns) + 1)) AS u(d)
), n AS (
  SELECT key, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size_all = depth), '') AS ends FROM p GROUP BY key
), k AS (
  SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1
), s AS (
  SELECT n.key[1:j] AS key, sum(saved) AS saved_tokens, sum(CASE WHEN k.key IS NULL THEN 1 ELSE 0 END) AS n_leaves FROM n LEFT JOIN k USING (key), unnest(range(0, n.depth + 1)) AS u(j) GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s USING (key) LEFT JOIN k USING (key) LEFT JOIN n up ON n.depth > 0 AND up.key = n.key[1:n.depth - 1]
"""

AUDIT_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), f AS (
  SELECT doc_id, part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM w
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask
), x AS (SELECT unnest(range(0, 5)) AS i
), o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), e AS (
  SELECT list_aggregate(list_transform(o, lambda i: 'ABCDE'[i + 1]), 'string_agg', '') AS filter_order, s::INT AS step, o[s] AS f, (1 << o[s])::INT AS bit, coalesce(list_sum(list_transform(o[1:s - 1], lambda i: 1 << i)), 0)::INT AS state FROM o, unnest(range(1, 6)) AS u(s)
), r AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN mask & (state | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & bit > 0 AND mask & state = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & state > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & state = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & bit > 0 AND mask & state = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, e GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
"""

ORACLE_SQL = {"op11_prefix_trie": TRIE_SQL, "op13_filter_audit": AUDIT_SQL, "op4_url_reputation": URL_SQL, "op9_topk": TOPK_SQL}
