"""Code lines, calls, versions and batches of texts on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import batches, code
from ..operators import relational as R
from ..session import table
from .base import query


@query("""
WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT user_id, event_type, event_id FROM l""")
def valid_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Results of the current version only, the latest for each key; an event's version is the hash of its type."""
    live = table(spark, sf, "events").withColumn("version", F.sha2("event_type", 256)).where(F.col("version") == F.sha2(F.lit("purchase"), 256))
    return R.latest_per_key(live.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id")
def longest_first(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id")


@query('SELECT p_partkey, v.i::INT AS "at", v.kind FROM part, ' + "(VALUES (2, 'direct'), (3, 'wrapper'), (5, 'mention')) v(i, kind)")
def line_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Each part is a small program of six lines."""
    size = F.col("p_size").cast("string")
    text = F.concat(F.lit("import tools\ndef helper"), size, F.lit("():\n    tools.run("), size, F.lit(")\nhelper"), size, F.lit("()\n# tools.run()\nprint('tools')"))
    return code.line_kinds(table(spark, sf, "part").select("p_partkey", text.alias("text")), "p_partkey", "text", "tools").select("p_partkey", "at", "kind")


@query(r"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '\b(track)\s*\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)', 1) AS n, regexp_extract_all(html, '\b(track)\s*\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)', 2) AS a FROM pages)
SELECT page_id, (i - 1)::INT AS position, n[i] AS name, a[i] AS arguments FROM x, unnest(range(1, len(n) + 1)) u(i)""")
def balanced_calls(spark: SparkSession, sf: str) -> DataFrame:
    return code.balanced_calls(table(spark, sf, "pages"), "page_id", "html", "track").select("page_id", "position", "name", "arguments")


@query("""
SELECT p_partkey, list_sort(list_distinct(['lib' || p_size, 'os', 'base'])) AS modules, 'lib' || p_size || '.Model' AS class,
  'import os, lib' || p_size || chr(10) || 'from base.x import y' || chr(10) || '  pass' AS code FROM part""")
def scalar_code(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    text = F.concat(F.lit("import os, lib"), size, F.lit("\nfrom base.x import y\n  %matplotlib inline"))
    return table(spark, sf, "part").select(
        "p_partkey", T.imported_modules(text).alias("modules"), T.canonical_class(F.concat(F.lit("lib"), size, F.lit(".inner.deep.Model"))).alias("class"), T.replace_magics(text).alias("code")
    )


@query("SELECT o_orderkey, concat_ws(chr(10), 'status: ' || o_orderstatus, 'priority: ' || o_orderpriority) AS body, sha256(concat_ws(chr(10), 'status: ' || o_orderstatus, 'priority: ' || o_orderpriority))[1:16] AS request FROM orders")
def compose_text(spark: SparkSession, sf: str) -> DataFrame:
    body = T.compose(("status", F.col("o_orderstatus")), ("note", F.lit(" ")), ("priority", F.col("o_orderpriority")))
    return table(spark, sf, "orders").select("o_orderkey", body.alias("body")).withColumn("request", F.substring(T.text_hash(F.col("body")), 1, 16))


@query()
def embed_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as vectors by the hashed stand-in of an embedding model, once for each distinct text."""
    from ..streaming.ingest import process_once

    return process_once(table(spark, sf, "documents"), "doc_id", "text", batches.hashed_embedding)
