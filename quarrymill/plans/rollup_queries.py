"""Aggregates and entity jobs on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import entity as E
from ..operators import relational as R
from ..operators import rollup as A
from ..session import table
from .base import query


@query("""
SELECT l_partkey, bool_or(l_returnflag = 'R') AS returned, list_sort(list_distinct(list(l_linestatus))) AS statuses,
  CASE WHEN bool_or(l_returnflag = 'R') THEN 'R' WHEN bool_or(l_returnflag = 'A') THEN 'A' ELSE 'N' END AS strongest,
  arg_min(CASE WHEN l_discount > 0 THEN l_discount END, (l_shipdate, l_orderkey, l_linenumber, l_discount)) FILTER (l_discount > 0) AS first_discount
FROM lineitem GROUP BY l_partkey""")
def pool_entities(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem")
    discount = F.when(F.col("l_discount") > 0, F.col("l_discount"))
    return rows.groupBy("l_partkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("returned"), A.union_list(F.array("l_linestatus")).alias("statuses"),
        A.strongest(F.col("l_returnflag"), ["R", "A", "N"]).alias("strongest"),
        A.first_known(discount, F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_discount")).alias("first_discount"),
    )


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def freq(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("""
SELECT v.position::INT AS position, v.value, count(o.o_orderkey) AS n FROM (VALUES (0, 'O'), (1, 'F'), (2, 'P'), (3, 'X')) v(position, value)
LEFT JOIN orders o ON o.o_orderstatus = v.value GROUP BY ALL""")
def freq_all_cats(spark: SparkSession, sf: str) -> DataFrame:
    return A.freq_all(table(spark, sf, "orders"), "o_orderstatus", ["O", "F", "P", "X"])


@query(r"""
SELECT item, count(*) AS n FROM (SELECT doc_id, unnest(list_distinct(regexp_split_to_array(lower(text), '[^a-z]+'))) AS item FROM documents)
WHERE item <> '' GROUP BY item ORDER BY n DESC, item LIMIT 25""")
def tally_topk(spark: SparkSession, sf: str) -> DataFrame:
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "")
    return A.tally(table(spark, sf, "documents"), words, 25)


@query("SELECT count(DISTINCT lower(c_mktsegment)) AS segments, count(DISTINCT lower(c_name)) AS names, count(c_name) - count(DISTINCT c_name) AS repeated FROM customer")
def distinct_ci(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").agg(
        F.count_distinct(F.lower("c_mktsegment")).alias("segments"), F.count_distinct(F.lower("c_name")).alias("names"), (F.count("c_name") - F.count_distinct("c_name")).alias("repeated")
    )


@query("""
SELECT l_returnflag, count(*) FILTER (l_discount BETWEEN 0.05 AND 0.07) AS n_mid, round(avg((l_quantity > 25)::INT::DOUBLE), 6) AS share_large FROM lineitem GROUP BY l_returnflag""")
def shares(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_if(F.col("l_discount").between(0.05, 0.07)).alias("n_mid"), F.round(F.avg((F.col("l_quantity") > 25).cast("double")), 6).alias("share_large")
    )


@query("""
WITH e AS (SELECT embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)
SELECT round(min(x), 6) AS x_min, round(max(x), 6) AS x_max, round(quantile_cont(x, 0.5), 6) AS x_median, round(quantile_cont(x, 0.99) - quantile_cont(x, 0.01), 6) AS x_spread,
  round(quantile_cont(y, 0.99) - quantile_cont(y, 0.01), 6) AS y_spread FROM e""")
def spread(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    got = e.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.percentile("x", F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99))).alias("px"), F.percentile("y", F.array(F.lit(0.01), F.lit(0.99))).alias("py"))
    return got.select(
        F.round("lo", 6).alias("x_min"), F.round("hi", 6).alias("x_max"), F.round(F.col("px")[1], 6).alias("x_median"),
        F.round(F.col("px")[2] - F.col("px")[0], 6).alias("x_spread"), F.round(F.col("py")[1] - F.col("py")[0], 6).alias("y_spread"),
    )


def _calls(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as calls: an order is an entity, flag, status and number its arguments."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount", "l_quantity")
    kwargs = F.map_from_arrays(F.array(F.lit("status"), F.lit("flag")), F.array(F.col("l_linestatus"), F.when(F.col("l_returnflag") == "N", F.lit("<expr>")).otherwise(F.col("l_returnflag"))))
    return rows.withColumn("kwargs", kwargs)


CALLS_SQL = """
WITH c AS (SELECT l_orderkey, l_linenumber, l_linestatus AS status, CASE WHEN l_returnflag = 'N' THEN '<expr>' ELSE l_returnflag END AS flag, l_discount, l_quantity FROM lineitem)
"""


@query(CALLS_SQL + """, k AS (SELECT l_orderkey, '{"flag":"' || flag || '","status":"' || status || '"}' AS key, count(*) AS n, min((l_linenumber, flag, status)) AS f FROM c GROUP BY ALL)
SELECT l_orderkey, list(key || ' x' || n ORDER BY n DESC, f, key) AS configurations FROM k GROUP BY l_orderkey""")
def config_rollup(spark: SparkSession, sf: str) -> DataFrame:
    calls = _calls(spark, sf).withColumn("flag", F.col("kwargs")["flag"]).withColumn("status", F.col("kwargs")["status"])
    return A.config_rollup(calls, "l_orderkey", "kwargs", ["l_linenumber", "flag", "status"])


@query("""
WITH p AS (SELECT user_id, unnest(json_keys(props)) AS arg, props FROM events)
SELECT user_id, arg, list_sort(list_distinct(list(json_extract_string(props, '$.' || arg)))) AS written, 0::BIGINT AS n_unresolved FROM p GROUP BY user_id, arg""")
def arg_summary(spark: SparkSession, sf: str) -> DataFrame:
    calls = table(spark, sf, "events").select("user_id", F.from_json("props", "map<string,string>").alias("kwargs"))
    return A.arg_summary(calls, "user_id", "kwargs")


@query(CALLS_SQL + """, a AS (SELECT l_orderkey, 'flag' AS arg, flag AS v FROM c UNION ALL SELECT l_orderkey, 'status', status FROM c),
s AS (SELECT l_orderkey, arg, count(*) FILTER (v <> '<expr>') AS w, count(*) FILTER (v = '<expr>') AS x FROM a GROUP BY ALL),
t AS (SELECT arg, v, count(DISTINCT l_orderkey) AS n FROM a WHERE v <> '<expr>' GROUP BY arg, v), r AS (SELECT *, row_number() OVER (PARTITION BY arg ORDER BY n DESC, v) AS r FROM t),
k AS (SELECT arg, list(v || ' x' || n ORDER BY r) AS commonest FROM r WHERE r <= 2 GROUP BY arg)
SELECT s.arg, count(*) AS passing, count(*) FILTER (w > 0) AS written, count(*) FILTER (w = 0 AND x > 0) AS unread, coalesce(any_value(commonest), []) AS commonest FROM s LEFT JOIN k USING (arg) GROUP BY s.arg""")
def arg_report(spark: SparkSession, sf: str) -> DataFrame:
    return A.arg_report(A.arg_summary(_calls(spark, sf), "l_orderkey", "kwargs"), 2)


@query("""
WITH o AS (SELECT l_orderkey, list(l_linestatus) AS methods, list(l_shipmode) AS called, bool_or(l_quantity = 1) AS one, bool_or(l_linenumber = 4) AS four FROM (SELECT *, 'lib.' || l_returnflag || '.' || l_linestatus AS l_shipmode FROM lineitem) GROUP BY l_orderkey)
SELECT l_orderkey, list_filter([CASE WHEN list_contains(methods, 'O') THEN 'open' END, CASE WHEN len(list_filter(called, lambda c: c LIKE 'lib.R.%')) > 0 THEN 'returns' END, CASE WHEN four THEN 'four' END, NULL], lambda x: x IS NOT NULL) AS features FROM o""")
def feature_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Flags by methods, names and arguments with their type: 4 is an argument's value, "4" and 4.0 aren't."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.collect_set("l_linestatus").alias("methods"), F.collect_set(F.concat_ws(".", F.lit("lib"), "l_returnflag", "l_linestatus")).alias("called"),
        F.collect_list(F.create_map(F.lit("n"), F.col("l_linenumber").cast("string"))).alias("kwargs"),
    )
    rules = [("open", {"methods": ["O", "X"]}), ("returns", {"called": r"^lib\.R\."}), ("four", {"argument": ("n", 4)}), ("text", {"argument": ("n", "4"), "learns": True})]
    return lines.select("l_orderkey", A.features_used(A.feature_rules(F.col("methods"), F.col("called"), F.col("kwargs"), F.lit(False), rules)).alias("features"))


@query(CALLS_SQL + """, g AS (SELECT l_orderkey, count(DISTINCT CASE WHEN l_discount > 0.02 AND flag <> '<expr>' THEN flag END) AS n, min(CASE WHEN l_discount > 0.02 AND flag <> '<expr>' THEN flag END) AS v,
  bool_or(l_discount > 0.02 AND flag = '<expr>') AS hidden, bool_or(l_discount <= 0.02 AND l_quantity <= 45) AS left_out FROM c GROUP BY l_orderkey),
r AS (SELECT l_orderkey, v, CASE WHEN n > 1 THEN 'SEVERAL' WHEN n = 1 THEN 'VALUE' WHEN left_out AND NOT hidden THEN 'DEFAULT' ELSE 'UNREADABLE' END AS answer FROM g)
SELECT l_orderkey, answer, CASE WHEN answer = 'VALUE' THEN v END AS value FROM r""")
def value_given(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("l_discount") > 0.02, F.col("kwargs")["flag"])
    return A.value_given(_calls(spark, sf), "l_orderkey", value, F.col("l_quantity") > 45)


@query(CALLS_SQL + """, g AS (SELECT l_orderkey, count(*) FILTER (l_discount > 0) AS y, count(*) FILTER (l_discount = 0 AND l_quantity <= 45) AS n FROM c GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN y > 0 AND n = 0 THEN 'EVERY' WHEN y > 0 THEN 'SOME' WHEN n > 0 THEN 'NEVER' ELSE 'UNREADABLE' END AS given FROM g""")
def how_often(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("l_discount") > 0, F.col("l_discount").cast("string"))
    return A.how_often(_calls(spark, sf), "l_orderkey", value, F.col("l_quantity") > 45)


@query("""
WITH o AS (SELECT l_orderkey, list_distinct(list(l_returnflag)) AS flags, list_distinct(list(l_linestatus)) AS statuses, max(l_quantity) AS q FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, list_filter([CASE WHEN list_contains(flags, 'R') THEN 'returns' END, CASE WHEN list_contains(statuses, 'O') AND list_contains(statuses, 'F') THEN 'mixed' END, CASE WHEN q >= 50 THEN 'bulk' END], lambda x: x IS NOT NULL) AS features FROM o""")
def features(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("flags"), F.collect_set("l_linestatus").alias("statuses"), F.max("l_quantity").alias("q"))
    rules = [("returns", F.array_contains("flags", "R")), ("mixed", F.exists("statuses", lambda s: s.rlike("^O$")) & F.array_contains("statuses", "F")), ("bulk", F.col("q") >= 50)]
    return o.select("l_orderkey", A.features_used(rules).alias("features"))


@query("""
WITH e AS (SELECT DISTINCT source, lang AS label FROM documents), n AS (SELECT label, count(*) AS n FROM e GROUP BY label)
SELECT source, arg_min(label, (n, CASE label WHEN 'en' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 WHEN 'es' THEN 4 ELSE 0 END, label)) AS label FROM e JOIN n USING (label) GROUP BY source""")
def rarest(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").groupBy("source").agg(F.collect_set("lang").alias("labels"))
    return A.rarest(rows, "source", "labels", ["en", "fr", "de", "es"])


@query("""
WITH w AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS ls FROM events WHERE event_type IN ('click', 'view', 'signup') AND value > 80 GROUP BY user_id),
e AS (SELECT user_id, unnest(ls) AS label FROM w), n AS (SELECT label, count(*) AS n FROM e GROUP BY label),
b AS (SELECT user_id, arg_min(label, (n, CASE label WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 3 END, label)) AS label FROM e JOIN n USING (label) GROUP BY user_id)
SELECT user_id, CASE WHEN ls = ['click', 'view'] THEN 'browsing' ELSE label END AS label FROM w JOIN b USING (user_id)""")
def rarest_pair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").where("event_type in ('click', 'view', 'signup') and value > 80").groupBy("user_id").agg(F.collect_set("event_type").alias("labels"))
    return A.rarest(rows, "user_id", "labels", ["click", "view", "signup"], {("click", "view"): "browsing"})


@query("""
WITH n AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand)
SELECT CASE WHEN n < 80 THEN 'Other' ELSE p_brand END AS shown, count(*) AS parts FROM part JOIN n USING (p_brand) GROUP BY 1""")
def fold_rare(spark: SparkSession, sf: str) -> DataFrame:
    return A.fold_rare(table(spark, sf, "part").select("p_brand"), "p_brand", 80).groupBy("shown").agg(F.count("*").alias("parts"))


@query("SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS cost, sum(l_quantity) AS tokens FROM lineitem GROUP BY l_returnflag")
def cost_rollup(spark: SparkSession, sf: str) -> DataFrame:
    cost = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum(cost), 2).alias("cost"), F.sum("l_quantity").alias("tokens"))


@query("""
WITH f AS (SELECT l_orderkey, 'f' || l_linenumber || CASE WHEN l_linenumber % 2 = 0 THEN '/sub' ELSE '' END AS path, l_linenumber % 2 AS depth, l_tax < 0.06 AS named, l_discount < 0.08 AS whole,
  l_returnflag = 'R' AS direct, l_linestatus, l_quantity AS entries, CASE WHEN l_discount > 0.02 THEN '==' || l_suppkey END AS spec, l_quantity > 40 AS dump, 'v' || l_suppkey % 3 AS via FROM lineitem)
SELECT l_orderkey, CASE WHEN bool_or(named AND direct) THEN 'declared' WHEN bool_or(named) THEN 'lock only' WHEN bool_or(NOT whole) THEN 'unread' ELSE 'not found' END AS status,
  list_sort(coalesce(list(DISTINCT path) FILTER (named AND direct), [])) AS declared_in, list_sort(coalesce(list(DISTINCT path) FILTER (named AND NOT direct), [])) AS locked_in,
  CASE WHEN bool_or(named AND direct AND l_linestatus = 'O') THEN 'required' WHEN bool_or(named AND direct) THEN 'dev' END AS scope, max(entries) FILTER (named AND direct) AS longest, max(entries) FILTER (named AND direct) - 1 AS pinned,
  list_sort(coalesce(list(DISTINCT via) FILTER (named AND NOT direct), [])) AS via, coalesce(bool_and(dump) FILTER (named AND direct), FALSE) AS dumped, count(*) AS n_files, count(*) FILTER (NOT whole) AS n_unread,
  arg_min(spec, (dump, -depth, path, spec)) FILTER (named AND direct AND spec IS NOT NULL) AS spec FROM f GROUP BY l_orderkey""")
def classify_files(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_linenumber")
    files = table(spark, sf, "lineitem").select(
        "l_orderkey", F.concat(F.lit("f"), n.cast("string"), F.when(n % 2 == 0, "/sub").otherwise("")).alias("path"), (F.col("l_tax") < 0.06).alias("named"),
        (F.col("l_discount") < 0.08).alias("whole"), (F.col("l_returnflag") == "R").alias("direct"),
        F.when(F.col("l_linestatus") == "O", "required").otherwise("dev").alias("scope"), F.col("l_quantity").alias("entries"),
        F.when(F.col("l_discount") > 0.02, F.concat(F.lit("=="), F.col("l_suppkey").cast("string"))).alias("spec"), (F.col("l_quantity") > 40).alias("dump"),
        (F.col("l_quantity") - 1).alias("pinned"), F.array(F.concat(F.lit("v"), (F.col("l_suppkey") % 3).cast("string"))).alias("via"),
    )
    return A.classify_files(files, "l_orderkey")


@query("""
SELECT user_id, list_sort(list_distinct(list(event_type))) AS kinds, count(*) AS n, count(*) FILTER (value > 50) AS n_large, bool_or(event_type = 'purchase') AS bought, max(value) AS top FROM events GROUP BY user_id""")
def facts_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.array_sort(F.collect_set("event_type")).alias("kinds"), F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("n_large"), F.bool_or(F.col("event_type") == "purchase").alias("bought"), F.max("value").alias("top")
    )


@query("""
WITH r AS (SELECT o_orderkey, o_custkey, o_orderstatus <> 'O' AS fork, o_totalprice, o_orderdate,
  CASE WHEN o_orderstatus <> 'O' THEN (o_custkey % 500)::VARCHAR ELSE o_orderkey::VARCHAR END AS p FROM orders),
fam AS (SELECT p, count(*) AS n, arg_min(o_orderkey, (-o_totalprice, -epoch_us(o_orderdate), o_orderkey)) AS f FROM r WHERE fork GROUP BY p),
o AS (SELECT DISTINCT o_orderkey::VARCHAR AS p FROM r WHERE NOT fork)
SELECT r.o_orderkey, coalesce(fam.n, 0) AS n_forks FROM r LEFT JOIN fam ON fam.p = r.o_orderkey::VARCHAR WHERE NOT fork
UNION ALL
SELECT r.o_orderkey, CASE WHEN o.p IS NULL AND fam.f = r.o_orderkey THEN fam.n - 1 ELSE 0 END FROM r JOIN fam ON fam.p = r.p LEFT JOIN o ON o.p = r.p
WHERE fork AND (o_totalprice >= 400000 OR (o.p IS NULL AND fam.f = r.o_orderkey))""")
def representatives(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("fork", F.col("o_orderstatus") != "O")
    orders = orders.withColumn("parent", F.when(F.col("fork"), (F.col("o_custkey") % 500).cast("string")))
    return E.representatives(orders, "o_orderkey", "parent", "fork", "o_totalprice", "o_orderdate", 400000).select("o_orderkey", "n_forks")


@query(r"""
WITH d AS (SELECT doc_id, n_chars, lang, sha256(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS text_hash FROM documents WHERE text IS NOT NULL AND length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 200)
SELECT arg_min(doc_id, (-n_chars, doc_id)) AS doc_id, text_hash, count(*) - 1 AS n_identical_copies FROM d GROUP BY text_hash""")
def copy_collapse(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where(F.length(T.ustrip(F.col("text"))) >= 200)
    return E.copy_collapse(docs, "doc_id", "text", "n_chars").select("doc_id", "text_hash", "n_identical_copies")


@query(r"""
WITH d AS (SELECT doc_id, n_chars, lang, sha256(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS h FROM documents WHERE length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 200),
a AS (SELECT arg_min(doc_id, (-n_chars, doc_id)) AS key, h, count(*) - 1 AS n_copies FROM d GROUP BY h),
p AS (SELECT page_id, html, sha256(html) AS h FROM pages WHERE length(html) >= 200),
b AS (SELECT min(page_id) AS key, h, count(*) - 1 AS n_copies FROM p WHERE h NOT IN (SELECT h FROM a) GROUP BY h)
SELECT 'document:' || key AS entity, 'document' AS source, n_copies FROM a UNION ALL SELECT 'page:' || key, 'page', n_copies FROM b WHERE key NOT IN (SELECT key FROM a)""")
def candidate_corpus(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where(F.length(T.ustrip(F.col("text"))) >= 200)
    a = E.copy_collapse(docs, "doc_id", "text", "n_chars").select(F.col("doc_id").alias("key"), F.col("text_hash").alias("h"), F.col("n_identical_copies").alias("n_copies"))
    pages = table(spark, sf, "pages").where(F.length("html") >= 200).withColumn("h", F.sha2("html", 256))
    b = R.not_represented(pages, a.select("h"), "h").groupBy("h").agg(F.min("page_id").alias("key"), (F.count("*") - 1).alias("n_copies"))
    b = R.not_represented(b, a.select("key"), "key")
    named = lambda df, s: df.select(F.concat(F.lit(s + ":"), F.col("key").cast("string")).alias("entity"), F.lit(s).alias("source"), "n_copies")
    return R.align_union(named(a, "document"), named(b, "page"), columns=["entity", "source", "n_copies"])


@query("SELECT sha256(text) AS job, list_sort(list_distinct(list(doc_id))) AS entities, count(*) AS shared_by FROM documents WHERE text IS NOT NULL GROUP BY sha256(text)")
def shared_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return E.shared_jobs(table(spark, sf, "documents"), "doc_id", "text")


@query("""
WITH u AS (SELECT user_id, bool_or(event_type = 'purchase') AS c, bool_or(event_type = 'signup') AS i, bool_or(event_type = 'click') AS e, bool_or(event_type = 'view') AS n, max(value) AS v FROM events WHERE value > 95 GROUP BY user_id)
SELECT user_id, CASE WHEN v <= 96 THEN 'no code' WHEN c THEN 'calls' WHEN i THEN 'imports only' WHEN e THEN 'through another' WHEN n THEN 'names only' WHEN v > 99 THEN 'mentions' ELSE 'no mention' END AS use FROM u""")
def use_class(spark: SparkSession, sf: str) -> DataFrame:
    of = lambda t: F.collect_set(F.when(F.col("event_type") == t, F.col("event_type")))
    u = table(spark, sf, "events").where("value > 95").groupBy("user_id").agg(of("purchase").alias("c"), of("signup").alias("i"), of("click").alias("e"), of("view").alias("n"), F.max("value").alias("v"))
    return u.select("user_id", E.use_class(F.col("c"), F.col("i"), F.col("e"), F.col("n"), F.col("v") > 99, F.col("v") > 96).alias("use"))


@query("""
WITH l AS (SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_returnflag) AS nf, min(l_returnflag) AS f, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, c_name, n_name, r_name, coalesce(n_lines, 0) AS n_lines, CASE WHEN nf IS NULL THEN 'None' WHEN nf = 1 THEN f ELSE 'Several' END AS flag,
  lower(concat_ws(' ', c_name, n_name, r_name, o_orderstatus)) AS search_text, round(least(log10(coalesce(quantity, 0) + 1), 3), 6) AS size
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN l ON l_orderkey = o_orderkey""")
def wide_table(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n_lines"), F.count_distinct("l_returnflag").alias("nf"), F.min("l_returnflag").alias("f"), F.sum("l_quantity").alias("quantity")
    )
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("n_nationkey"))
    places = table(spark, sf, "nation").join(table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select("n_nationkey", "n_name", "r_name")
    wide = R.join_1to1(R.join_1to1(R.join_1to1(table(spark, sf, "orders"), customer, "o_custkey"), places, "n_nationkey"), lines, "o_orderkey")
    flag = F.when(F.col("nf").isNull(), "None").when(F.col("nf") == 1, F.col("f")).otherwise("Several")
    return wide.select(
        "o_orderkey", "c_name", "n_name", "r_name", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), flag.alias("flag"),
        F.lower(F.concat_ws(" ", "c_name", "n_name", "r_name", "o_orderstatus")).alias("search_text"), F.round(T.log_size(F.coalesce("quantity", F.lit(0.0)), 3.0), 6).alias("size"),
    )


@query("""
SELECT value, n, row_number() OVER (ORDER BY value = 'ECONOMY', n DESC, value)::INT AS place FROM (SELECT coalesce(p_type, 'Unknown') AS value, count(*) AS n FROM part GROUP BY 1)""")
def legend_order(spark: SparkSession, sf: str) -> DataFrame:
    return E.legend_order(table(spark, sf, "part"), "p_type", ["ECONOMY"])


@query(r"""
SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(concat_ws(' ', lang, source, text)), '[^\p{L}\p{N}_=.]+'), 'en') AND list_contains(regexp_split_to_array(lower(concat_ws(' ', lang, source, text)), '[^\p{L}\p{N}_=.]+'), 'the')""")
def search(spark: SparkSession, sf: str) -> DataFrame:
    index = E.search_index(table(spark, sf, "documents"), "doc_id", F.concat_ws(" ", "lang", "source", "text"))
    return E.search(index, "doc_id", ["en", "the"])


@query("""
SELECT year(o_orderdate) AS year, count(*) AS n, round(avg((o_orderpriority LIKE '1%')::INT::DOUBLE), 6) AS urgent, round(avg(CASE WHEN o_orderstatus = 'F' THEN (o_totalprice > 200000)::INT::DOUBLE END), 6) AS large_done FROM orders GROUP BY 1""")
def cohort_share(spark: SparkSession, sf: str) -> DataFrame:
    urgent, large = F.col("o_orderpriority").startswith("1").cast("double"), (F.col("o_totalprice") > 200000).cast("double")
    return table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year")).agg(
        F.count("*").alias("n"), F.round(F.avg(urgent), 6).alias("urgent"), F.round(F.avg(F.when(F.col("o_orderstatus") == "F", large)), 6).alias("large_done")
    )
