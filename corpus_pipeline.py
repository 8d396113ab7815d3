"""The corpus pipeline: toxicity, line dedup, n-gram Jaccard join, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of documents. Stages of a caller are written as Parquet in between; run() does so itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import decontamination, jaccard_join, line_dedup, packing, toxicity
from quarrymill.llm.common import free_name, id_remainder, materialize
from quarrymill.llm.components import sized_join


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents scored 0.5 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, id_remainder("doc_id", 5) != 0)
    score = free_name(docs, "score")
    return toxicity.score_texts(docs, model, docs.columns, out=score).where(F.col(score) < 0.5).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one line of each component stays; documents whose lines all went go."""
    lines, gone = free_name(docs, "lines"), free_name(docs, "dropped")
    out = line_dedup.dedup_lines(docs, counts=(lines, gone)).where((F.col(gone) == 0) | (F.col(gone) < F.col(lines)))
    return out.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text")).otherwise(F.col("n_chars"))).select(docs.columns)


def with_row(docs: DataFrame) -> DataFrame:
    """Adds __row, never null, which tells rows apart that share an id or have none; null ids sort last, then the text's hash decides."""
    return docs.withColumn("__row", F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one row of each component stays, that with the least id, then text hash; without words, all stay."""
    rows = with_row(docs)
    found = materialize(jaccard_join.jaccard_components(rows, key="__row"), "components")
    gone = found.where("n_shingles > 0 and __row <> component_id").select("__row").distinct()
    kept = sized_join(rows, materialize(gone, "gone"), "__row", "left_anti", 32)
    repeated = materialize(found.where("n_shingles > 0 and __row = component_id").groupBy("__row").count().where("count > 1").select("__row"), "repeated")
    if repeated.limit(1).count():  # rows that repeat an id and a text: one of them stays
        rest = sized_join(kept, repeated, "__row", "left_anti", 32)
        kept = rest.unionByName(sized_join(kept, repeated, "__row", "left_semi", 32).dropDuplicates(["__row"]))
    return kept.select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: rows that hold a benchmark item, or one with other numbers and names, go."""
    rows = with_row(docs)
    leaks = decontamination.benchmark_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="__row")
    return decontamination.leaking_rows(rows, leaks, key="__row").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("jaccard_join", dedup_documents),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# The first stage is a fitted model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
