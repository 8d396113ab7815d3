"""Streaming and vector queries on the driver's tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import vectors as V
from ..session import table
from ..sources.logs import write_verified
from ..streaming import ingest as S
from .base import query


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return S.open_stream(spark, f"{sf}/events.parquet")


@query("SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    sink, checkpoint = S.new_place(spark, "ingest")
    for _ in range(2):  # the second run finds nothing new
        S.ingest(_events(spark, sf), sink, checkpoint)
    return spark.read.parquet(sink).groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL")
def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    _, checkpoint = S.new_place(spark, "latest")
    S.upsert_latest(_events(spark, sf).select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], ["ts", "event_id"], checkpoint)
    return S.state(spark, checkpoint).select("user_id", "event_type", "event_id")


@query("""
WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS last FROM events GROUP BY user_id)
SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM l WHERE last IN ('purchase', 'signup'))""")
def todo_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return S.todo(keys, table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "event_type", ["purchase", "signup"])


@query("SELECT doc_id, sha256(text) AS hash, length(text) AS result FROM documents")
def process_once(spark: SparkSession, sf: str) -> DataFrame:
    return S.process_once(table(spark, sf, "documents"), "doc_id", "text", F.length)


@query("""
SELECT conv_id, arg_max(role = 'assistant', turn) AS complete, sum(length(text)) AS counted, arg_max(turn, turn) AS stated, arg_max(turn, turn) - sum(length(text)) AS difference FROM conversations GROUP BY conv_id""")
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    pages = turns.select("conv_id", "turn", F.when(F.col("role") != "assistant", F.col("role")).alias("cursor"), F.length("text").alias("counted"), F.col("turn").alias("stated"))
    return S.reconcile(pages, "conv_id", "turn", "cursor", "counted", "stated")


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_window(spark: SparkSession, sf: str) -> DataFrame:
    counts = S.window_counts(_events(spark, sf), "ts", "1 day", "1 hour", ["event_type"], "windows")
    return counts.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""
WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, m GROUP BY ALL HAVING date_trunc('day', min(ts)) + INTERVAL 1 DAY <= any_value(mark)""")
def stream_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that the watermark has closed, each written once."""
    sink, checkpoint = S.new_place(spark, "closed")
    closed = S.closed_windows(_events(spark, sf), "ts", "1 day", "1 hour", ["event_type"], "value", sink, checkpoint)
    return closed.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT 2::BIGINT AS runs, count(*) AS n, 0::BIGINT AS late, round(sum(value), 2) AS total, count(DISTINCT (user_id, event_type)) AS kept FROM events")
def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """The progress of two runs, the second of which finds nothing new, as a table read from their log."""
    sink, checkpoint = S.new_place(spark, "progress")
    keep = lambda stream: S.upsert_latest(stream, ["user_id", "event_type"], ["ts", "event_id"], checkpoint)
    counted = {"n": F.count(F.lit(1)), "total": F.sum("value")}
    events = _events(spark, sf).select("user_id", "event_type", "ts", "event_id", "value")
    for _ in range(2):
        log = S.run_measured(events, counted, keep, f"{sink}/log")
    return log.agg(F.lit(2).cast("long").alias("runs"), F.sum(F.col("seen")["n"]).cast("long").alias("n"), F.sum("late_rows").alias("late"), F.round(F.sum(F.col("seen")["total"]), 2).alias("total"), F.max("state_rows").alias("kept"))


@query("""
WITH v AS (SELECT sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM embeddings)
SELECT count(*) AS n_rows, 0::BIGINT AS n_bad, round(min(n), 6) AS norm_min, round(max(n), 6) AS norm_max FROM v""")
def vector_stats(spark: SparkSession, sf: str) -> DataFrame:
    return V.vector_stats(table(spark, sf, "embeddings"), "embedding")


@query("""
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), p AS (
  SELECT a.vec_id, 1 - list_cosine_similarity(a.v, b.v) AS d, b.vec_id AS o FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, rank::INT AS rank, round(d, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, o) AS rank FROM p) WHERE rank <= 15""")
def knn(spark: SparkSession, sf: str) -> DataFrame:
    return V.knn(table(spark, sf, "embeddings"), "vec_id", "embedding", 15).select("vec_id", "rank", F.round("distance", 6).alias("distance"))


@query()
def fuzzy_graph(spark: SparkSession, sf: str) -> DataFrame:
    near = V.knn(table(spark, sf, "embeddings"), "vec_id", "embedding", 15)
    return V.fuzzy_graph(near, "vec_id").select("a", "b", F.round("weight", 6).alias("weight"))


@query()
def layout_pca(spark: SparkSession, sf: str) -> DataFrame:
    return V.layout_pca(table(spark, sf, "embeddings"), "vec_id", "embedding")


def _coords(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


@query("""
WITH e AS (SELECT vec_id, embedding[1]::DOUBLE AS x0, embedding[2]::DOUBLE AS y0 FROM embeddings),
t AS (SELECT quantile_cont(y0, 0.99) - quantile_cont(y0, 0.01) > quantile_cont(x0, 0.99) - quantile_cont(x0, 0.01) AS tall FROM e),
r AS (SELECT vec_id, CASE WHEN tall THEN y0 ELSE x0 END AS x, CASE WHEN tall THEN -x0 ELSE y0 END AS y FROM e, t),
m AS (SELECT min(x) AS xa, max(x) AS xb, min(y) AS ya, max(y) AS yb FROM r),
c AS (SELECT count(*) FILTER (x >= xb - 0.15 * (xb - xa) AND y <= ya + 0.15 * (yb - ya)) AS c0, count(*) FILTER (x <= xa + 0.15 * (xb - xa) AND y <= ya + 0.15 * (yb - ya)) AS c1,
  count(*) FILTER (x >= xb - 0.15 * (xb - xa) AND y >= yb - 0.15 * (yb - ya)) AS c2, count(*) FILTER (x <= xa + 0.15 * (xb - xa) AND y >= yb - 0.15 * (yb - ya)) AS c3 FROM r, m),
b AS (SELECT arg_min(i, (n, f, i)) AS i FROM (SELECT 0 AS i, c0 AS n, 0 AS f FROM c UNION ALL SELECT 1, c1, 1 FROM c UNION ALL SELECT 2, c2, 1 FROM c UNION ALL SELECT 3, c3, 2 FROM c))
SELECT vec_id, round(CASE WHEN i IN (1, 3) THEN -x ELSE x END, 6) AS x, round(CASE WHEN i IN (2, 3) THEN -y ELSE y END, 6) AS y FROM r, b""")
def orient(spark: SparkSession, sf: str) -> DataFrame:
    return V.orient(_coords(spark, sf), "vec_id").select("vec_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def _layout(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    graph = write_verified(V.fuzzy_graph(V.knn(vectors, "vec_id", "embedding", 15), "vec_id"), "graph")
    return V.layout_spectral(graph, V.layout_pca(vectors, "vec_id", "embedding"), "vec_id")


@query()
def layout_spectral(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinates from the neighbour graph, begun at the principal components."""
    return _layout(spark, sf)


def _regions(spark: SparkSession, sf: str) -> DataFrame:
    laid = V.orient(write_verified(_layout(spark, sf), "layout"), "vec_id")
    return V.regions(laid, "vec_id", [48, 24, 12, 6], 10)


@query()
def regions(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(spark, sf)


@query()
def layer_stats(spark: SparkSession, sf: str) -> DataFrame:
    return V.layer_stats(_regions(spark, sf))


@query(r"""
WITH w AS (SELECT lang, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS term FROM documents),
tf AS (SELECT lang, term, count(*) AS tf FROM w WHERE term <> '' GROUP BY ALL), f AS (SELECT term, sum(tf) AS f FROM tf GROUP BY term),
a AS (SELECT sum(tf) / count(DISTINCT lang) AS a FROM tf), s AS (SELECT lang, term, round(tf * ln(1 + a / f), 6) AS score FROM tf JOIN f USING (term), a)
SELECT lang, place::INT AS place, term, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) AS place FROM s) WHERE place <= 10""")
def region_terms(spark: SparkSession, sf: str) -> DataFrame:
    return V.region_terms(table(spark, sf, "documents"), "lang", "text", 10)
