"""The final table and its parts on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import code, report, rollup
from ..session import spread, table
from .base import query
from .usage_queries import _programs


@query("""
WITH c AS (SELECT l_orderkey, CASE WHEN l_tax > 0.07 THEN '<expr>' WHEN l_discount > 0.02 THEN l_linenumber::VARCHAR END AS v, l_quantity > 45 AS star FROM lineitem),
g AS (SELECT l_orderkey, count(DISTINCT CASE WHEN v <> '<expr>' THEN v END) AS n, min(CASE WHEN v <> '<expr>' THEN v END) AS v, bool_or(v = '<expr>') AS hidden, bool_or(v IS NULL AND NOT star) AS left_out FROM c GROUP BY l_orderkey),
a AS (SELECT l_orderkey, CASE WHEN n > 1 THEN 'SEVERAL' WHEN n = 1 THEN 'VALUE' WHEN left_out AND NOT coalesce(hidden, FALSE) THEN 'DEFAULT' ELSE 'UNREADABLE' END AS answer, CASE WHEN n = 1 THEN v END AS value FROM g),
k AS (SELECT value, count(*) AS n FROM a WHERE answer = 'VALUE' GROUP BY value)
SELECT o_orderkey, CASE WHEN answer IS NULL THEN 'No call to read' WHEN answer = 'SEVERAL' THEN 'Several values' WHEN answer = 'DEFAULT' THEN 'Default (2)' WHEN answer = 'UNREADABLE' THEN 'Not readable'
  WHEN k.n < 20 THEN 'Other' WHEN a.value = '2' THEN '2, written out' ELSE a.value END AS label FROM orders LEFT JOIN a ON l_orderkey = o_orderkey LEFT JOIN k ON k.value = a.value""")
def value_labels(spark: SparkSession, sf: str) -> DataFrame:
    calls = table(spark, sf, "lineitem").select("l_orderkey", F.when(F.col("l_tax") > 0.07, "<expr>").when(F.col("l_discount") > 0.02, F.col("l_linenumber").cast("string")).alias("v"), (F.col("l_quantity") > 45).alias("star"))
    given = rollup.value_given(calls, "l_orderkey", F.col("v"), F.col("star"))
    answers = table(spark, sf, "orders").select("o_orderkey").join(given.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    return report.value_labels(answers, "o_orderkey", "2", 20)


@query("""
WITH c AS (SELECT l_returnflag AS model, l_partkey AS plain, CASE WHEN l_linenumber = 1 THEN l_suppkey END AS stored, CASE WHEN l_linenumber > 2 THEN l_suppkey END AS found, l_quantity::BIGINT AS answers FROM lineitem),
g AS (SELECT model, count(*) AS calls, sum(plain) AS plain, coalesce(sum(stored), 0) AS stored, coalesce(sum(found), 0) AS found, sum(answers) AS answers, count(*) FILTER (found > 0) AS hits, count(*) FILTER (stored > 0) AS writes FROM c GROUP BY model),
l AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' ELSE 'R' END AS model, count(*) AS n_left FROM orders GROUP BY 1),
p AS (SELECT g.*, coalesce(n_left, 0) AS n_left, CASE model WHEN 'A' THEN 3.0 WHEN 'N' THEN 1.0 ELSE 15.0 END AS pin, CASE model WHEN 'A' THEN 15.0 WHEN 'N' THEN 5.0 ELSE 75.0 END AS pout, hits::DOUBLE / nullif(hits + writes, 0) AS rate FROM g LEFT JOIN l USING (model)),
q AS (SELECT *, (stored + found) * pin * n_left / calls / 2e6 AS shared, plain * pin * n_left / calls / 2e6 AS rest, answers * pout * n_left / calls / 2e6 AS said FROM p)
SELECT model, calls, (plain + stored + found)::BIGINT AS input_tokens, answers::BIGINT AS output_tokens, round((plain * pin + stored * pin * 1.25 + found * pin * 0.1 + answers * pout) / 2e6, 6)::DOUBLE AS cost, round(rate, 6) AS hit_rate,
  round(shared * (rate * 0.1 + (1 - rate) * 1.25) + rest + said, 6)::DOUBLE AS left_cached, round(shared + rest + said, 6)::DOUBLE AS left_plain FROM q""")
def cost_report(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_linenumber")
    calls = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("model"), F.col("l_partkey").alias("input_tokens"), F.when(n == 1, F.col("l_suppkey")).alias("cache_written"),
        F.when(n > 2, F.col("l_suppkey")).alias("cache_read"), F.col("l_quantity").cast("long").alias("output_tokens"),
    )
    status = F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "N").otherwise("R")
    left = table(spark, sf, "orders").groupBy(status.alias("model")).agg(F.count("*").alias("n_left"))
    return report.cost_report(calls, {"A": (3.0, 15.0), "N": (1.0, 5.0), "R": (15.0, 75.0)}, left)


@query("""
WITH p AS (SELECT p_partkey, p_size::VARCHAR AS s, p_partkey % 6 AS shape FROM part)
SELECT p_partkey, CASE shape WHEN 0 THEN 'import tools' || chr(10) || '...' || chr(10) || 'tools.Model(**d)' WHEN 2 THEN 'import tools' || chr(10) || '...' || chr(10) || 'tools.Model(size=a.n_size, **extra)'
  WHEN 3 THEN 'import tools' || chr(10) || '...' || chr(10) || 'def run(k=' || s || '):' || chr(10) || '    return tools.Model(size=k, **{''seed'': k})'
  ELSE '    import tools' || chr(10) || '...' || chr(10) || '    tools = None' || chr(10) || '...' || chr(10) || 'm = tools.Model(size=k)' || chr(10) || 'm = m.fit(rows)' || chr(10) || 'print(m.size_)' || chr(10) || 'm.predict(rows)' END AS excerpt FROM p WHERE shape NOT IN (1, 4)""")
def project_excerpts(spark: SparkSession, sf: str) -> DataFrame:
    """Each part is a project of one file: its calls with what encloses them, what becomes of their results, its imports."""
    windows = {"call": (0, 0, 0.7), "result": (0, 0, 0.9), "mention": (0, 0, 1.0)}
    got = code.project_excerpts(spread(_programs(spark, sf)), "p_partkey", "path", "text", "tools", 2000, windows, r"\bModel\(")
    return got.select("p_partkey", "excerpt")


@query("""
WITH o AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS done, list_sort(list_distinct(list(o_orderpriority))) AS kinds, max(o_totalprice) AS top FROM orders GROUP BY o_custkey),
e AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS last, count(*) AS events FROM events GROUP BY user_id),
d AS (SELECT doc_id, lang, source, n_chars FROM documents), l AS (SELECT doc_id, quality, toxic FROM labels), p AS (SELECT page_id, url FROM pages),
w AS (SELECT c_custkey, c_name, n_name, coalesce(n, 0) AS n, coalesce(done, 0) AS done, coalesce(kinds, []) AS kinds, last, coalesce(events, 0) AS events, lang, source, quality, toxic, url,
    CASE WHEN o.n IS NULL THEN 'no code' WHEN done = n THEN 'calls' WHEN done > 0 THEN 'imports only' ELSE 'names only' END AS use FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN o ON o_custkey = c_custkey LEFT JOIN e ON user_id = c_custkey LEFT JOIN d ON d.doc_id = c_custkey LEFT JOIN l ON l.doc_id = c_custkey LEFT JOIN p ON page_id = c_custkey)
SELECT c_custkey, n_name, use, CASE WHEN use = 'calls' THEN array_to_string(['Every order'] || list_filter(kinds, lambda k: k <> 'Every order'), ', ') WHEN last IS NOT NULL AND last <> 'view' THEN last || ' (stated)' ELSE 'Every order' END AS purposes,
  CASE WHEN lang IS NULL THEN 'Unknown' WHEN quality IS NULL THEN lang WHEN quality = 1 THEN lang || ' · good' ELSE lang || ' · poor' END AS data, CASE WHEN toxic = 1 THEN 'Rejected' WHEN toxic = 0 THEN 'Kept' ELSE 'Not judged' END AS verdict,
  CASE WHEN url IS NULL THEN 'No page' ELSE 'Has a page' END AS page, concat_ws(' · ', c_name, CASE WHEN events > 0 THEN events || ' events' END, source) AS footer, lower(concat_ws(' ', c_name, n_name, use, lang)) AS search FROM w""")
def final_table(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with five validated joins, one answer for each question, details and a search text."""
    named = lambda t, key, *cols: table(spark, sf, t).select(F.col(key).alias("c_custkey"), *cols)
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.array_sort(F.collect_set("o_orderpriority")).alias("kinds"))
    events = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last"), F.count("*").alias("events"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    customers = customers.join(table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_nationkey", "left")
    wide = report.answered(customers, "c_custkey", [
        (orders, {}), (events, {"events": 0}), (named("documents", "doc_id", "lang", "source"), {}), (named("labels", "doc_id", "quality", "toxic"), {}), (named("pages", "page_id", "url"), {}),
    ])
    use = F.when(F.col("n").isNull(), "no code").when(F.col("done") == F.col("n"), "calls").when(F.col("done") > 0, "imports only").otherwise("names only")
    kinds = F.coalesce("kinds", F.array().cast("array<string>"))
    form = F.when(F.col("quality") == 1, "Good").when(F.col("quality") == 0, "Poor")
    return wide.withColumn("use", use).select(
        "c_custkey", "n_name", "use", report.use_detail(F.col("use"), F.lit("Every order"), kinds, F.col("last"), ["view"]).alias("purposes"),
        report.data_detail(F.col("lang").isNotNull(), F.coalesce("lang", F.lit("Unknown")), form, F.lit(""), "Other", ["Unknown"]).alias("data"),
        F.when(F.col("toxic") == 1, "Rejected").when(F.col("toxic") == 0, "Kept").otherwise("Not judged").alias("verdict"), F.when(F.col("url").isNull(), "No page").otherwise("Has a page").alias("page"),
        T.footer(F.col("c_name"), F.when(F.col("events") > 0, F.concat(F.col("events").cast("string"), F.lit(" events"))), F.col("source")).alias("footer"),
        F.lower(F.concat_ws(" ", "c_name", "n_name", "use", "lang")).alias("search"),
    )


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'Lock file only, via ' || p_type || ', x' || CASE WHEN p_size % 2 = 0 THEN ' +1' ELSE '' END WHEN 1 THEN 'Dependency list (setup.py, optional) >=' || p_size WHEN 2 THEN 'Dependency list (package metadata), any version'
    WHEN 3 THEN 'Environment dump (env.yml, development), from source' ELSE 'Not found' END AS declaration,
  CASE p_size % 5 WHEN 1 THEN 'Lower bound' WHEN 2 THEN 'Any version' WHEN 3 THEN 'Environment dump' ELSE 'Not in a dependency list' END AS versions,
  CASE p_size % 4 WHEN 0 THEN 'Model(size=' || p_size || ') · +2 other configurations · Features: ' || p_type || ' · Reduces rows.' WHEN 1 THEN 'Another (b.compute)' WHEN 2 THEN 'Mentions (imported, never called)' ELSE 'None' END AS code FROM part""")
def details(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of a card: how a package is declared, which versions are asked for, what the code does."""
    size, five, four = F.col("p_size"), F.col("p_size") % 5, F.col("p_size") % 4
    text, none = size.cast("string"), F.array().cast("array<string>")
    category = F.when(five == 0, "Lock file only").when(five <= 2, "Dependency list").when(five == 3, "Environment dump").otherwise("Not found")
    via = F.when(five == 0, F.when(size % 2 == 0, F.array(F.col("p_type"), F.lit("x"), F.lit("y"))).otherwise(F.array(F.col("p_type"), F.lit("x")))).otherwise(none)
    paths = F.when(five == 1, F.array(F.lit("a/deep/reqs.txt"), F.lit("poetry.lock"), F.lit("p/setup.py"))).otherwise(F.array(F.lit("env.yml")))
    scope = F.when(five == 1, "optional").when(five == 3, "dev").otherwise("required")
    spec = F.when(five == 1, F.concat(F.lit(">="), text)).when(five == 2, "").when(five == 3, "from source")
    listed = five.isin(1, 2, 3)
    made = F.struct(F.lit("tools.Model").alias("name"), F.create_map(F.lit("size"), text).alias("kwargs"), F.lit(False).alias("star"), F.lit(1).alias("n"))
    use = F.when(four == 0, "calls").when(four == 1, "through another").when(four == 2, "imports only").otherwise("no mention")
    label = F.when(four == 0, "Calls").when(four == 1, "Another").when(four == 2, "Mentions").otherwise("None")
    return table(spark, sf, "part").select(
        "p_partkey", report.declaration_detail(category, listed, five == 0, via, paths, scope, spec, five == 2).alias("declaration"),
        report.version_category(F.when(spec.isNotNull(), T.version_kind(spec)["kind"]), five.isin(1, 2), five == 3).alias("versions"),
        report.code_detail(use, label, F.array(F.lit("a.pl.show"), F.lit("b.compute")), none, F.array(made, made, made), none, F.array(F.col("p_type")), F.lit("Reduces rows.")).alias("code"),
    )
