"""Scans, filters, joins, windows, orders and set operations on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import relational as R
from ..session import table
from ..sources import logs
from .base import query

USTRIP_SQL = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"


@query("SELECT doc_id, lang, n_chars FROM documents WHERE n_chars > 500")
def scan_pruned(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars").where("n_chars > 500")


@query("SELECT event_id, user_id, event_type, value FROM events")
def log_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Events appended to a log in two goes and read back."""
    from ..streaming.ingest import new_place

    at, _ = new_place(spark, "log")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    for half in (F.col("value") < 50, (F.col("value") >= 50) | F.col("value").isNull()):
        logs.append_log(events.where(half), at)
    return logs.read_log(spark, at, "event_id long, user_id long, event_type string, value double")


@query("SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, 6 AS n_columns FROM orders")
def verified_write(spark: SparkSession, sf: str) -> DataFrame:
    written = logs.write_verified(table(spark, sf, "orders"), "orders-verified")
    return written.agg(F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys")).withColumn("n_columns", F.lit(len(written.columns)))


@query(r"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 1) AS l, regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)</a>', 2) AS t FROM pages)
SELECT page_id, (i - 1)::INT AS position, l[i] AS link, t[i] AS label FROM x, unnest(range(1, len(l) + 1)) AS u(i)""")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return logs.page_links(table(spark, sf, "pages"), "page_id", "html")


@query("SELECT event_id, user_id, event_type, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def flatten_json(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.select("event_id", "user_id", "event_type", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT conv_id, string_agg(text, chr(10) || '# ---' || chr(10) ORDER BY turn) AS body, count(*) AS n_cells FROM conversations WHERE role = 'assistant' GROUP BY conv_id")
def join_cells(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").where("role = 'assistant' and text is not null")
    cells = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(cells, lambda c: c["text"]), "\n# ---\n").alias("body"), F.count("*").alias("n_cells"))


@query("SELECT doc_id, CASE WHEN text IS NULL THEN 'missing' WHEN octet_length(encode(text)) > 5000 THEN 'too big' ELSE 'ok' END AS status FROM documents")
def route_by_size(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", T.store_status(F.col("text").cast("binary"), 5000).alias("status"))


@query(f"""
WITH d AS (SELECT doc_id, {USTRIP_SQL} AS t, n_chars FROM documents),
r AS (SELECT CASE WHEN t IS NULL THEN 1 WHEN length(t) < 200 THEN 2 WHEN row_number() OVER (PARTITION BY sha256(t) ORDER BY n_chars DESC, doc_id) > 1 THEN 3 END AS f FROM d WHERE TRUE),
s AS (SELECT * FROM (VALUES (1, 'no text'), (2, 'short'), (3, 'copy')) v(step, reason))
SELECT step::INT AS step, reason, (SELECT count(*) FROM r WHERE f IS NULL OR f >= step) AS before, (SELECT count(*) FROM r WHERE f IS NULL OR f > step) AS after, (SELECT count(*) FROM r WHERE f = step) AS dropped FROM s""")
def funnel(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", T.ustrip(F.col("text")).alias("t"), "n_chars").withColumn("hash", F.sha2("t", 256))
    best = docs.where("hash is not null").groupBy("hash").agg(F.min(F.struct(-F.col("n_chars"), "doc_id"))["doc_id"].alias("first"))
    docs = docs.join(best, "hash", "left")
    return R.funnel(docs, [("no text", F.col("t").isNotNull()), ("short", F.length("t") >= 200), ("copy", F.col("first") == F.col("doc_id"))])


@query("""
SELECT coalesce(CASE WHEN quality = 1 AND toxic = 0 THEN 'good' WHEN n_chars >= 5000 THEN 'long' WHEN quality IS NULL THEN 'not judged' END, 'dropped') AS reason, count(*) AS n
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def keep_reason(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.join_1to1(table(spark, sf, "documents").select("doc_id", "n_chars"), table(spark, sf, "labels"), "doc_id")
    rules = [("good", F.expr("quality = 1 and toxic = 0")), ("long", F.col("n_chars") >= 5000), ("not judged", F.col("quality").isNull())]
    return R.keep_reason(rows, rules).groupBy(F.coalesce("reason", F.lit("dropped")).alias("reason")).agg(F.count("*").alias("n"))


@query("""
WITH h AS (SELECT DISTINCT d.doc_id FROM documents d JOIN benchmark b ON contains(d.text, b.text))
SELECT d.doc_id, CASE WHEN h.doc_id IS NOT NULL THEN 'code' WHEN l.quality = 1 THEN 'declared' WHEN d.text ILIKE '%this%' THEN 'described' ELSE 'unread' END AS reason
FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN h USING (doc_id)
WHERE h.doc_id IS NOT NULL OR l.quality = 1 OR d.text ILIKE '%this%' OR l.doc_id IS NULL""")
def evidence_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    from ..operators.entity import contained_quotes

    hits = contained_quotes(docs, "doc_id", "text", table(spark, sf, "benchmark"), "item_id", "text", squeeze=False).select("doc_id").distinct().withColumn("hit", F.lit(True))
    rows = R.join_1to1(docs.select("doc_id", F.lower("text").contains("this").alias("mention")), labels.withColumn("labelled", F.lit(True)), "doc_id").join(hits, "doc_id", "left")
    rules = [("code", F.col("hit")), ("declared", F.col("quality") == 1), ("described", F.col("mention")), ("unread", F.col("labelled").isNull())]
    return R.keep_reason(rows, rules).where("reason is not null").select("doc_id", "reason")


@query("SELECT doc_id, regexp_matches(concat_ws(chr(10), lang, source, text), '(?i)\\bthis\\b') AS mentioned FROM documents".replace("\\\\", "\\"))
def mentions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.concat_ws("\n", "lang", "source", "text").rlike(r"(?i)\bthis\b").alias("mentioned"))


@query(r"""
SELECT page_id, CASE WHEN regexp_matches(url, '/(en|de)/\d+\.html') THEN 'document' WHEN regexp_matches(url, '[?]') THEN 'query' WHEN regexp_matches(url, '#') THEN 'anchor' WHEN regexp_matches(url, '/$') THEN 'folder' ELSE 'other' END AS class FROM pages""")
def url_class(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    rules = [("document", u.rlike(r"/(en|de)/\d+\.html")), ("query", u.rlike("[?]")), ("anchor", u.rlike("#")), ("folder", u.rlike("/$"))]
    return table(spark, sf, "pages").select("page_id", R.category(rules, "other").alias("class"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'large done' WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority LIKE '1%' THEN 'urgent' ELSE 'open' END AS class FROM orders""")
def case_ladder(spark: SparkSession, sf: str) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    rules = [("large done", done & (F.col("o_totalprice") > 200000)), ("done", done), ("urgent", F.col("o_orderpriority").startswith("1"))]
    return table(spark, sf, "orders").select("o_orderkey", R.category(rules, "open").alias("class"))


@query("SELECT c_mktsegment, lower(substr(c_mktsegment, 1, 3)) AS code, count(*) AS n FROM customer GROUP BY 1, 2")
def recode(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer")
    codes = rows.select("c_mktsegment").where("c_mktsegment is not null").distinct().withColumn("code", F.lower(F.substring("c_mktsegment", 1, 3)))
    coded = rows.join(codes, "c_mktsegment", "left")
    return coded.groupBy("c_mktsegment", "code").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS flag FROM lineitem")
def recode_total(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup that stops the job at a value it has no code for."""
    flag = R.recode(F.col("l_returnflag"), {"A": "accepted", "N": "none", "R": "returned"})
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", flag.alias("flag"))


@query("""
WITH b AS (SELECT coalesce(c, o) AS k, c IS NULL AS r, o IS NULL AS l FROM (SELECT DISTINCT c_custkey AS c FROM customer) FULL JOIN (SELECT DISTINCT o_custkey AS o FROM orders) ON c = o)
SELECT count(*) FILTER (l) AS only_left, count(*) FILTER (r) AS only_right, count(*) FILTER (l OR r) = 0 AS same FROM b""")
def same_keys(spark: SparkSession, sf: str) -> DataFrame:
    return R.same_keys(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), "k")


@query("""
SELECT doc_id, CASE WHEN text IS NULL THEN 'missing' WHEN octet_length(encode(text)) + CASE WHEN lang = 'de' THEN 2 ELSE 0 END > 5000 THEN 'too big' WHEN lang = 'de' THEN 'binary' ELSE 'ok' END AS status FROM documents""")
def route_binary(spark: SparkSession, sf: str) -> DataFrame:
    """Blobs: the German texts with a null byte in front."""
    raw = F.concat(F.when(F.col("lang") == "de", F.unhex(F.lit("4100"))).otherwise(F.unhex(F.lit(""))), F.col("text").cast("binary"))
    return table(spark, sf, "documents").select("doc_id", T.store_status(raw, 5000).alias("status"))


@query("""
SELECT p_partkey, v.path, v.class FROM part, (VALUES ('src/a.py', 'code'), ('Requirements.txt', 'dependency'), ('reqs/base.in', 'dependency'), ('x/requirements-frozen.txt', 'lock'), ('poetry.lock', 'lock'), ('.venv3/lib/a.py', 'vendored'),
  ('lib/python3.9/x.py', 'vendored'), ('conda/environment.yaml', 'dependency'), ('env-dev.yml', 'dependency'), ('docs/readme.txt', 'other'), ('n.ipynb', 'notebook'), ('envs/a.py', 'code'), ('constraints.txt', 'lock')) v(path, class) WHERE length(v.path) <= p_size""")
def path_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Each part lists the paths that are no longer than its size."""
    paths = ["src/a.py", "Requirements.txt", "reqs/base.in", "x/requirements-frozen.txt", "poetry.lock", ".venv3/lib/a.py", "lib/python3.9/x.py", "conda/environment.yaml", "env-dev.yml", "docs/readme.txt", "n.ipynb", "envs/a.py", "constraints.txt"]
    listed = table(spark, sf, "part").select("p_partkey", "p_size", F.explode(F.array(*[F.lit(p) for p in paths])).alias("path")).where(F.length("path") <= F.col("p_size"))
    return listed.select("p_partkey", "path", T.path_class(F.col("path")).alias("class"))


@query(r"SELECT doc_id, coalesce(nullif(regexp_replace(text, '^\s+|\s+$', '', 'g'), ''), lang, source) AS title FROM documents")
def fallback(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.coalesce(T.nonblank(T.ustrip(F.col("text"))), "lang", "source").alias("title"))


@query("SELECT 'customer' AS source, c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier")
def align_union(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.lit("supplier").alias("source"))
    return R.align_union(a, b, columns=["source", "key", "name", "segment"])


@query("SELECT doc_id, sha256(doc_id::VARCHAR) AS h FROM documents ORDER BY h, doc_id LIMIT 50")
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return R.hash_sample(table(spark, sf, "documents").select("doc_id"), "doc_id", 50)


@query("""
SELECT l.doc_id, l.quality AS as_answered, CASE WHEN l.quality = 1 AND NOT contains(lower(d.text), 'the') THEN -1 WHEN l.quality = 0 AND contains(lower(d.text), 'the') THEN 2 ELSE l.quality END AS label
FROM labels l JOIN documents d USING (doc_id)""")
def label_correct(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", F.contains(F.lower("text"), F.lit("the")).alias("named")), "doc_id")
    label = F.when((F.col("quality") == 1) & ~F.col("named"), -1).when((F.col("quality") == 0) & F.col("named"), 2).otherwise(F.col("quality"))
    return rows.select("doc_id", F.col("quality").alias("as_answered"), label.alias("label"))


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def left_1to1(spark: SparkSession, sf: str) -> DataFrame:
    return R.join_1to1(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 150000")
def inner_join(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders").where("o_totalprice > 150000"), table(spark, sf, "customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select("o_orderkey", "c_name", "c_mktsegment")


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000) AS big FROM customer")
def membership_flags(spark: SparkSession, sf: str) -> DataFrame:
    big = table(spark, sf, "orders").where("o_totalprice > 300000")
    return R.membership(table(spark, sf, "customer").select("c_custkey"), F.col("c_custkey"), big, "o_custkey", "big")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return R.not_represented(table(spark, sf, "customer").select("c_custkey", "c_name"), orders, "c_custkey")


@query("SELECT s_suppkey, lower(n_name) AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def map_join(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.lower("n_name").alias("nation"))
    return table(spark, sf, "supplier").join(nation, "s_nationkey", "left").select("s_suppkey", "nation")


@query("SELECT c.conv_id, c.turn, c.role FROM conversations c WHERE EXISTS (SELECT 1 FROM conversations h WHERE h.conv_id = c.conv_id AND h.role = 'assistant' AND h.turn BETWEEN c.turn - 1 AND c.turn + 2)")
def context_window(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return R.neighbourhood(turns.where("role = 'assistant'"), turns, "conv_id", "turn", 2, 1).select("conv_id", "turn", "role")


@query("SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(regexp_replace(d.text, '\\s+', ' ', 'g'), regexp_replace(b.text, '\\s+', ' ', 'g')) WHERE length(b.text) >= 8".replace("\\\\", "\\"))
def evidence_verify(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.entity import contained_quotes

    return contained_quotes(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "benchmark"), "item_id", "text")


@query("""
SELECT doc_id, list_filter([CASE WHEN regexp_matches(text, '\\b\\d{1,3}(\\.\\d{1,3}){3}\\b') THEN 'address' END, CASE WHEN contains(text, '@') THEN 'mail' END, CASE WHEN regexp_matches(text, '(?i)licen[cs]e') THEN 'license' END, CASE WHEN lang = 'en' AND regexp_matches(text, '\\btoken\\b') THEN 'token' END], lambda x: x IS NOT NULL) AS labels FROM documents""".replace("\\\\", "\\"))
def rule_match(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    rules = [("address", t.rlike(r"\b\d{1,3}(\.\d{1,3}){3}\b")), ("mail", t.contains("@")), ("license", t.rlike("(?i)licen[cs]e")), ("token", (F.col("lang") == "en") & t.rlike(r"\btoken\b"))]
    return table(spark, sf, "documents").select("doc_id", F.array_compact(F.array(*[F.when(ok, F.lit(n)) for n, ok in rules])).alias("labels"))


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY ALL")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return R.latest_per_key(table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], ["ts", "event_id"])


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS r FROM orders) WHERE r = 1")
def keep_first(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return R.keep_first(orders, ["o_custkey"], [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()])


@query("SELECT doc_id, count(*) OVER (PARTITION BY sha256(text)) - 1 AS n_copies FROM documents")
def copies(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    return R.group_size(docs, ["hash"], "n_copies", 1).select("doc_id", "n_copies")


@query("SELECT conv_id, turn, (row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1)::INT AS position FROM conversations")
def list_position(spark: SparkSession, sf: str) -> DataFrame:
    return R.running_position(table(spark, sf, "conversations").select("conv_id", "turn", "role"), "role", ["conv_id", "turn"]).select("conv_id", "turn", "position")


@query("""
WITH a AS (SELECT conv_id, turn, text, turn - lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) > 1 AS g FROM conversations WHERE role <> 'user')
SELECT conv_id, string_agg(CASE WHEN coalesce(g, false) THEN '...|' ELSE '' END || turn, '|' ORDER BY turn) AS shown FROM a GROUP BY conv_id""")
def islands(spark: SparkSession, sf: str) -> DataFrame:
    turns = R.islands(table(spark, sf, "conversations").where("role <> 'user'").select("conv_id", "turn"), "conv_id", "turn")
    line = F.concat(F.when(F.col("gap"), F.lit("...|")).otherwise(F.lit("")), F.col("turn").cast("string")).alias("line")
    parts = F.array_sort(F.collect_list(F.struct("turn", line)))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "|").alias("shown"))


@query("""
WITH e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
SELECT user_id, anchor, event_id FROM (
  SELECT a.user_id, a.event_id AS anchor, e.event_id, row_number() OVER (PARTITION BY a.event_id ORDER BY e.i) AS r
  FROM e a JOIN e ON a.user_id = e.user_id AND e.i BETWEEN a.i + 1 AND a.i + 10 WHERE a.event_type = 'signup' AND e.event_type <> 'signup') WHERE r <= 3""")
def hits_after(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.rollup import hits_after as after

    return after(table(spark, sf, "events"), "user_id", ["ts", "event_id"], "event_id", F.col("event_type") == "signup", reach=10, k=3)


@query("SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey)::INT AS turn FROM part")
def round_robin(spark: SparkSession, sf: str) -> DataFrame:
    return R.round_robin(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", [F.col("p_partkey")])


@query("SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS total, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS place FROM events")
def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Running sums of a few groups, each too large for a task."""
    from ..operators.prefix import running

    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    got = running(events, ["event_type"], ["ts", "event_id"], {"total": F.col("value"), "place": F.lit(1).cast("long")})
    return got.select("event_id", "user_id", F.round("total", 4).alias("total"), "place")


@query("SELECT doc_id, floor((sum(n_chars) OVER (PARTITION BY lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - 1) / 50000)::BIGINT AS batch FROM documents")
def pack_cumsum(spark: SparkSession, sf: str) -> DataFrame:
    return R.pack_cumsum(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "lang", [F.col("doc_id")], "n_chars", 50000).select("doc_id", F.col("batch").cast("long"))


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_name")
def ordered(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select("n_nationkey", "n_name").orderBy("n_name")


@query(r"""
WITH x AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, url, (regexp_matches(url, '/(de|fr|es)/'))::INT AS other, CASE WHEN url LIKE '%.html%' THEN 0 WHEN url LIKE '%/' THEN 1 ELSE 2 END AS rank FROM pages)
SELECT host, arg_min(page_id, (other, rank, url, page_id)) AS page_id FROM x GROUP BY host""")
def pick_best(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    rank = F.struct(u.rlike("/(de|fr|es)/").cast("int").alias("other"), F.when(u.contains(".html"), 0).when(u.endswith("/"), 1).otherwise(2).alias("rank"), "url", "page_id")
    return table(spark, sf, "pages").groupBy(F.regexp_extract("url", "://([^/?#]*)", 1).alias("host")).agg(F.min(rank)["page_id"].alias("page_id"))


@query(r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="(/[^"]*)">', 1) AS links FROM pages),
x AS (SELECT page_id, i, links[i] AS link, CASE WHEN lower(links[i]) LIKE '/the%' THEN 0 WHEN lower(links[i]) LIKE '/a%' THEN 1 ELSE 2 END AS rank FROM l, unnest(range(1, len(links) + 1)) u(i))
SELECT page_id, arg_min(link, (rank, i)) AS link FROM x WHERE length(link) > 3 GROUP BY page_id""")
def pick_url(spark: SparkSession, sf: str) -> DataFrame:
    links = logs.page_links(table(spark, sf, "pages"), "page_id", "html").where(F.length("link") > 3)
    low = F.lower("link")
    rank = F.when(low.startswith("/the"), 0).when(low.startswith("/a"), 1).otherwise(2)
    return links.groupBy("page_id").agg(F.min_by("link", F.struct(rank, "position")).alias("link"))


@query("SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS r FROM orders) WHERE r <= 5")
def cap_per_group(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    capped = R.at_most(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], 5)
    return R.round_robin(capped, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", F.col("turn").alias("r"))


@query(r"""
WITH x AS (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/]*([^?#]*)', 1) AS path FROM pages)
SELECT host, arg_min(path, ((path LIKE '%.html')::INT, len(string_split(path, '/')), path)) AS path FROM x GROUP BY host""")
def shallowest(spark: SparkSession, sf: str) -> DataFrame:
    x = table(spark, sf, "pages").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.regexp_extract("url", "://[^/]*([^?#]*)", 1).alias("path"))
    order = F.struct(F.col("path").endswith(".html").cast("int"), F.size(F.split("path", "/")), "path")
    return x.groupBy("host").agg(F.min_by("path", order).alias("path"))


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 5")
def topk(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(5)


@query("SELECT role, conv_id, n FROM (SELECT role, conv_id, count(*) AS n, row_number() OVER (PARTITION BY role ORDER BY count(*) DESC, conv_id) AS r FROM conversations GROUP BY role, conv_id) WHERE r <= 3")
def top_groups(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "conversations").groupBy("role", "conv_id").agg(F.count("*").alias("n"))
    return R.at_most(counts, ["role"], [F.desc("n"), F.col("conv_id")], 3)


@query(r"SELECT c_custkey, c_name, try_cast(regexp_extract(c_name, '(\d+)$', 1) AS INT) AS suffix FROM customer")
def natural_order(spark: SparkSession, sf: str) -> DataFrame:
    suffix = F.regexp_extract("c_name", r"(\d+)$", 1).try_cast("int").alias("suffix")
    return table(spark, sf, "customer").select("c_custkey", "c_name", suffix).orderBy("suffix", "c_custkey")


@query("""
WITH u AS (SELECT regexp_replace(lower(c_name), '^[a-z]+', '') AS k, c_name AS name, c_custkey AS key, 0 AS p FROM customer UNION ALL SELECT regexp_replace(lower(s_name), '^[a-z]+', ''), s_name, s_suppkey, 1 FROM supplier)
SELECT name, key FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, key DESC) AS r FROM u) WHERE r = 1""")
def precedence_union(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("key"))
    b = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return R.precedence_union([a, b], F.regexp_replace(F.lower("name"), "^[a-z]+", ""), [F.col("key")])


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'reread' ELSE o_orderstatus END AS status FROM orders")
def overlay(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    reread = orders.where("price > 250000").withColumn("status", F.lit("reread"))
    return R.precedence_union([reread, orders], F.col("o_orderkey"), [F.col("price")]).select("o_orderkey", "status")


@query("SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def except_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("key")).subtract(table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_custkey"))


@query("SELECT c_custkey AS key FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def intersect_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("key")).intersect(table(spark, sf, "orders").where("o_orderstatus = 'P'").select("o_custkey"))


@query("""
SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey IS NULL) AS null_o_orderkey, count(*) FILTER (o_custkey IS NULL) AS null_o_custkey, count(*) FILTER (o_totalprice < 0) AS small_o_totalprice, count(o_orderkey) - count(DISTINCT o_orderkey) AS repeated_o_orderkey FROM orders""")
def expectations(spark: SparkSession, sf: str) -> DataFrame:
    return R.expect(table(spark, sf, "orders"), unique=["o_orderkey"], not_null=["o_orderkey", "o_custkey"], minimum={"o_totalprice": 0})
