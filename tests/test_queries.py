"""Each registered query of the library against its SQL on the smallest tables; the others by their invariants."""

import pytest
from compare import both, duck
from pyspark.sql import functions as F

from quarrymill.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, con, name):
    mine, theirs = both(registry.QUERIES[name](spark, SF), con, registry.ORACLE_SQL[name])
    assert mine == theirs


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_fuzzy_graph_is_symmetric(spark):
    g = registry.QUERIES["fuzzy_graph"](spark, SF).cache()
    assert g.where("weight <= 0 or weight > 1").count() == 0
    back = g.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("weight").alias("w"))
    assert g.join(back, ["a", "b"]).where("weight = w").count() == g.count()


def test_regions_cover_all(spark):
    r = registry.QUERIES["regions"](spark, SF).cache()
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert r.groupBy("layer").count().where(f"count <> {n}").count() == 0
    assert r.where("region is not null").groupBy("layer", "region").count().where("count < 10").count() == 0


def test_pack_greedy_keeps_limits(spark):
    from quarrymill.operators.batches import pack_greedy

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = pack_greedy(docs, "doc_id", "n_chars", 100, 50_000, 8).join(docs, "doc_id")
    bad = packed.groupBy("shard", "batch").agg(F.sum("n_chars").alias("w"), F.count("*").alias("n")).where("n > 100 or (w > 50000 and n > 1)")
    assert packed.count() == docs.count() and bad.count() == 0


def test_excerpts_keep_budget(spark):
    got = registry.QUERIES["excerpts"](spark, SF)
    assert got.where("used > 2000").count() == 0 and got.where("used > 0").count() > 0


def test_permutation_changes_nothing(spark):
    from quarrymill.operators.rollup import rarest

    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"]), (3, ["c", "b"]), (4, [])], "e int, l array<string>")
    want = sorted(map(tuple, rarest(rows, "e", "l", ["a", "b", "c"]).collect()))
    assert want == [(1, "a"), (2, "b"), (3, "c"), (4, None)]
    assert sorted(map(tuple, rarest(rows.repartition(7).orderBy(F.desc("e")), "e", "l", ["a", "b", "c"]).collect())) == want


def test_recode_of_many_names(spark, tmp_path):
    from quarrymill.plans import relational_queries

    rows = [(k, f"{k:04d} segment") for k in range(1500)] + [(1500, None)]
    spark.createDataFrame(rows, "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    got = {r["c_mktsegment"]: (r["code"], r["n"]) for r in relational_queries.recode(spark, str(tmp_path)).collect()}
    assert got == {name: (name and name[:3], 1) for _, name in rows}
