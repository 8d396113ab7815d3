"""Scalar functions and dependency facts on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import batches, code, deps
from ..session import table
from ..sources.logs import write_verified
from .base import query

# A requirement string for each part: ten shapes by size.
SPEC_SQL = """CASE p_size % 10 WHEN 0 THEN '' WHEN 1 THEN '>=0.' || p_size WHEN 2 THEN '>=0.5,<' || p_size WHEN 3 THEN '==0.' || p_size || '.*'
  WHEN 4 THEN '~=0.5' WHEN 5 THEN '==1.' || p_size WHEN 6 THEN '!=0.4' WHEN 8 THEN '<9,>=0.' || p_size WHEN 9 THEN '==1.0,>=0.5' ELSE '<2' END"""


def _requirements(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").withColumn("req", F.concat(F.lit("Quarry_Mill "), F.expr(SPEC_SQL)))


@query(rf"""
SELECT p_partkey, spec, kind, CASE WHEN spec = '' THEN '' ELSE regexp_replace(split_part(spec, ',', CASE WHEN p_size % 10 IN (8, 9) THEN 2 ELSE 1 END), '^[=<>!~^]+', '') END AS anchor FROM (
  SELECT p_partkey, p_size, {SPEC_SQL} AS spec, CASE p_size % 10 WHEN 1 THEN 'Lower bound' WHEN 2 THEN 'Bounded' WHEN 3 THEN 'Compatible' WHEN 4 THEN 'Compatible' WHEN 5 THEN 'One version' WHEN 7 THEN 'Upper bound' WHEN 8 THEN 'Bounded' WHEN 9 THEN 'Lower bound' ELSE 'Any version' END AS kind FROM part)""")
def scalar_version(spark: SparkSession, sf: str) -> DataFrame:
    rows = _requirements(spark, sf).select("p_partkey", F.element_at(T.specifiers(F.col("req"), "quarry-mill"), 1).alias("spec"))
    kind = T.version_kind(F.col("spec"))
    return rows.select("p_partkey", "spec", kind["kind"].alias("kind"), kind["anchor"].alias("anchor"))


@query(r"""
SELECT p_partkey, regexp_replace(lower(p_name), '[-_.]+', '-', 'g') AS name, regexp_extract(p_name, '^\s*([A-Za-z0-9][A-Za-z0-9._-]*)', 1) AS head,
  CASE WHEN p_size % 3 = 0 THEN 'absent' WHEN p_size % 3 = 1 THEN 'optional' ELSE 'required' END AS dependency FROM part""")
def scalar_text(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size") % 3
    reqs = F.when(size == 0, F.array(F.lit("other>=1"), F.lit("quarry-mill-extra"))).when(size == 1, F.array(F.lit('quarry.mill; extra == "x"'))).otherwise(F.array(F.lit('quarry_mill>=1; extra == "x"'), F.lit("Quarry-Mill<3")))
    return table(spark, sf, "part").select("p_partkey", T.normalize_name(F.col("p_name")).alias("name"), T.head_name(F.col("p_name")).alias("head"), T.dependency_kind(reqs, "quarry-mill").alias("dependency"))


@query(r"""
SELECT doc_id, sha256(concat_ws(chr(0), lang, source, text)) AS hash, length(regexp_replace(text, '\s+', ' ', 'g')) AS squeezed,
  least(len(string_split(text, ' ')), 50) AS n_tokens, array_to_string(string_split(text, ' ')[1:50], ' ') AS head,
  CASE WHEN regexp_matches(lang, '[.?!]$') THEN upper(lang[1]) || lang[2:] ELSE upper(lang[1]) || lang[2:] || '.' END AS sentence FROM documents""")
def scalar_hash(spark: SparkSession, sf: str) -> DataFrame:
    head, n = T.truncate_tokens(F.col("text"), 50)
    return table(spark, sf, "documents").select(
        "doc_id", T.text_hash(F.col("lang"), F.col("source"), F.col("text")).alias("hash"), F.length(T.squeeze(F.col("text"))).alias("squeezed"),
        n.alias("n_tokens"), head.alias("head"), T.sentence(F.col("lang")).alias("sentence"),
    )


@query(r"""
WITH x AS (SELECT page_id, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, CASE WHEN regexp_matches(lower(list_last(string_split(path, '/'))), 'dev|test|doc|lint|bench') THEN 'dev' WHEN regexp_matches(lower(list_last(string_split(path, '/'))), 'optional|extra') THEN 'optional' ELSE 'required' END AS file_scope,
  CASE page_id % 4 WHEN 0 THEN 'required' WHEN 1 THEN 'optional' WHEN 2 THEN 'dev' END AS key_scope FROM x""")
def scalar_path(spark: SparkSession, sf: str) -> DataFrame:
    path = F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1)
    # a key path for each page: a table of dependencies, an optional one, one of a group, one of sources
    table_ = F.element_at(F.array(*[F.lit(x) for x in ("project.dependencies", "project.optional-dependencies", "dependency-groups", "tool.x.sources")]), (F.col("page_id") % 4 + 1).cast("int"))
    return table(spark, sf, "pages").select("page_id", T.file_scope(path).alias("file_scope"), T.key_path_scope(F.concat(table_, F.lit(".k"), F.col("page_id").cast("string"))).alias("key_scope"))


@query(r"""
SELECT page_id, nullif(regexp_replace(regexp_extract(url, '(?i)^(?:git\+)?https?://(?:www\.)?[\w-]+\.(?:com|org)/([^/\s]+/[^/\s?#]+)', 1), '\.git$', ''), '') AS repo,
  'page:' || page_id AS entity, try_cast(replace(regexp_extract(url, '([\d,]+)\s+pages', 1), ',', '') AS BIGINT) AS stated FROM pages""")
def scalar_url(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", T.repo_of(F.col("url")).alias("repo"), F.concat(F.lit("page:"), F.col("page_id").cast("string")).alias("entity"), T.stated_count(F.col("url"), "pages").alias("stated")
    )


@query("""
SELECT o_orderkey, year(o_orderdate) AS year, strftime(o_orderdate, '%Y-%m') AS month, round(least(log10(o_totalprice + 1), 5), 6) AS size,
  coalesce(CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END, (SELECT min(year(o_orderdate)) FROM orders)) AS filled,
  concat_ws(' · ', o_orderstatus, CASE WHEN o_orderpriority LIKE '1%' THEN o_orderpriority END, strftime(o_orderdate, '%Y')) AS footer FROM orders""")
def scalar_date(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    first = orders.agg(F.min(F.year("o_orderdate")).alias("y")).scalar()
    date = F.col("o_orderdate")
    return orders.select(
        "o_orderkey", F.year(date).cast("long").alias("year"), F.date_format(date, "yyyy-MM").alias("month"), F.round(T.log_size(F.col("o_totalprice"), 5.0), 6).alias("size"),
        F.coalesce(F.when(F.col("o_orderstatus") != "P", F.year(date)), first).cast("long").alias("filled"),
        T.footer(F.col("o_orderstatus"), F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")), F.date_format(date, "yyyy")).alias("footer"),
    )


@query("""
WITH e AS (SELECT l_orderkey, (l_partkey % 20)::VARCHAR AS name, (l_suppkey % 20)::VARCHAR AS dep, l_linenumber = 1 AS own FROM lineitem),
h AS (SELECT l_orderkey, bool_or(own) AS o, list_sort(coalesce(list(DISTINCT name) FILTER (NOT own), [])) AS via FROM e WHERE dep = '7' GROUP BY l_orderkey),
p AS (SELECT DISTINCT l_orderkey FROM e WHERE name = '7')
SELECT p.l_orderkey, coalesce(o, TRUE) OR len(via) = 0 AS direct, CASE WHEN coalesce(o, TRUE) OR len(via) = 0 THEN [] ELSE via END AS via FROM p LEFT JOIN h USING (l_orderkey)""")
def requirers(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda c: (F.col(c) % 20).cast("string")
    packages = table(spark, sf, "lineitem").select("l_orderkey", text("l_partkey").alias("name"), F.array(text("l_suppkey")).alias("deps"), (F.col("l_linenumber") == 1).alias("own"))
    return deps.requirers(packages, "l_orderkey", "name", "deps", "7", "own")


@query("SELECT event_id, '$.' || k AS path, json_extract_string(props, '$.' || k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def manifest_paths(spark: SparkSession, sf: str) -> DataFrame:
    return deps.key_paths(table(spark, sf, "events"), "event_id", "props")


@query(r"""
WITH x AS (SELECT doc_id, regexp_extract_all(text, '\b(token|secret|password)\s*=\s*"([^"\n]*)"', 1) AS n, regexp_extract_all(text, '\b(token|secret|password)\s*=\s*"([^"\n]*)"', 2) AS v FROM documents)
SELECT doc_id, (i - 1)::INT AS position, n[i] AS name, v[i] AS value FROM x, unnest(range(1, len(n) + 1)) u(i)""")
def call_regex(spark: SparkSession, sf: str) -> DataFrame:
    return code.keyword_literals(table(spark, sf, "documents"), "doc_id", "text", "token|secret|password")


@query("""
SELECT p_partkey, 'tools.' || 'Model' || p_size AS name, 'fit' AS method, 1::BIGINT AS n FROM part WHERE p_size % 4 <> 0
UNION ALL SELECT p_partkey, 'tools.Model' || p_size, NULL, 1 FROM part WHERE p_size % 4 <> 0""")
def code_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Each part is a small program; those of every fourth size don't import the library."""
    size = F.col("p_size").cast("string")
    lib = F.when(F.col("p_size") % 4 == 0, F.lit("gadgets")).otherwise(F.lit("tools"))
    text = F.concat(
        F.lit("try:\n    import "), lib, F.lit(" as t\nexcept ImportError:\n    t = None\nN = "), size, F.lit("\nM = N\nmodel = t.Model"), size,
        F.lit("(size=M, seed=42)\nmodel.fit(rows)\n# part "), F.col("p_partkey").cast("string"), F.lit(" with tools\n"),
    )
    files = table(spark, sf, "part").select("p_partkey", text.alias("text"))
    calls = code.resolved_calls(write_verified(code.code_facts(files, "text", "tools"), "facts"), "tools")  # many joins read the facts
    right = F.when(F.col("method").isNull(), (F.try_element_at("kwargs", F.lit("seed")) == "42")).otherwise(True)
    found = files.select("p_partkey", F.sha2("text", 256).alias("blob")).join(calls.where(right).hint("merge"), "blob")  # a file a text: neither side is small
    return found.groupBy("p_partkey", "name", "method").agg(F.count("*").alias("n"))


@query()
def excerpts(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").where("conv_id is not null and turn is not null")
    kind = F.when(F.col("role") == "assistant", "direct").when(F.col("text").contains("the"), "mention")
    lines = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("text"), F.min(kind).alias("kind"))
    return code.excerpts(lines, "conv_id", "turn", "text", [("direct", 1, 1, 0.7), ("mention", 0, 1, 1.0)], 2000)


@query("""
WITH RECURSIVE n AS (SELECT greatest(1, ceil(count(*) / 500))::BIGINT AS shards FROM documents),
d AS (SELECT doc_id, coalesce(n_chars, 0) AS w, (('0x' || md5(doc_id::VARCHAR)[1:8])::BIGINT % shards)::INT AS shard FROM documents, n),
r AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) AS i FROM d),
p AS (SELECT shard, i, doc_id, 0 AS batch, 1 AS n, w AS total FROM r WHERE i = 1
  UNION ALL SELECT r.shard, r.i, r.doc_id, CASE WHEN p.n >= 100 OR p.total + r.w > 50000 THEN p.batch + 1 ELSE p.batch END, CASE WHEN p.n >= 100 OR p.total + r.w > 50000 THEN 1 ELSE p.n + 1 END,
    CASE WHEN p.n >= 100 OR p.total + r.w > 50000 THEN r.w ELSE p.total + r.w END FROM p JOIN r ON r.shard = p.shard AND r.i = p.i + 1)
SELECT shard, batch, count(*) AS n, min(doc_id) AS first FROM p GROUP BY shard, batch""")
def pack_greedy(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("doc_id is not null")
    packed = batches.pack_greedy(docs, "doc_id", "n_chars", 100, 50_000, shard_rows=500)
    return packed.groupBy("shard", "batch").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


def _upper(values: list) -> list:
    """A stand-in for a remote batch call: it refuses batches that hold a text with the word trash."""
    if any("trash" in (v or "") for v in values):
        raise ValueError("refused")
    return [len(v or "") for v in values]


@query("SELECT doc_id, CASE WHEN contains(coalesce(text, ''), 'trash') THEN 'error' ELSE 'ok' END AS status, CASE WHEN contains(coalesce(text, ''), 'trash') THEN NULL ELSE length(coalesce(text, ''))::VARCHAR END AS result, CASE WHEN contains(coalesce(text, ''), 'trash') THEN 'ValueError: refused' END AS error FROM documents")
def map_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batches.map_batches(table(spark, sf, "documents"), "doc_id", "text", _upper, 32)


@query("""
WITH a AS (SELECT b.item_id, 'item ' || (b.item_id % 3) AS answer, b.text AS quote, d.text AS shown FROM benchmark b JOIN documents d ON d.doc_id = b.item_id)
SELECT item_id, CASE WHEN contains(regexp_replace(shown, '\\s+', ' ', 'g'), regexp_replace(quote, '\\s+', ' ', 'g')) THEN [answer] ELSE ['Can''t tell'] END AS kept,
  CASE WHEN contains(regexp_replace(shown, '\\s+', ' ', 'g'), regexp_replace(quote, '\\s+', ' ', 'g')) THEN [] ELSE [answer] END AS dropped FROM a""".replace("\\\\", "\\"))
def verified_answers(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.entity import verified_answers as verify

    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), F.col("text").alias("shown"))
    answers = table(spark, sf, "benchmark").join(docs, "item_id").withColumn("answer", F.concat(F.lit("item "), (F.col("item_id") % 3).cast("string")))
    return verify(answers, "item_id", "text", "answer", "shown")


@query("SELECT p_partkey, p_brand || '(size=' || CASE WHEN p_size % 2 = 0 THEN '…' ELSE p_size::VARCHAR END || ', type=' || p_type || ', name=' || CASE WHEN length(p_name || p_name) > 24 THEN (p_name || p_name)[1:23] || '…' ELSE p_name || p_name END || ', a=1, b=2, c=3' || CASE WHEN p_size % 3 = 0 THEN ', +1 more' ELSE '' END || ')' AS call, list_sort(list_filter(['size=' || p_size, 'type=' || p_type], lambda t: length(t) <= 40)) AS tokens FROM part")
def call_display(spark: SparkSession, sf: str) -> DataFrame:
    kwargs = F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("type"), F.col("p_type"))
    size = F.when(F.col("p_size") % 2 == 0, "<expr>").otherwise(F.col("p_size").cast("string"))
    shown = F.create_map(F.lit("size"), size, F.lit("type"), F.col("p_type"), F.lit("name"), F.concat("p_name", "p_name"), *[F.lit(x) for x in ("a", "1", "b", "2", "c", "3")])
    return table(spark, sf, "part").select("p_partkey", T.call_text(F.concat(F.lit("tools."), F.col("p_brand")), shown, F.col("p_size") % 3 == 0).alias("call"), T.argument_tokens(kwargs).alias("tokens"))


