"""The dealt operators on the driver's small tables: SQL, brute force, held-out accuracy, and the pipeline's stages."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import both, duck  # noqa: E402

from quarrymill.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, con, name):
    mine, theirs = both(queries.QUERIES[name](spark, SF), con, queries.ORACLE_SQL[name])
    assert mine == theirs


def test_jaccard_against_brute_force(spark, con):
    docs = con.execute("select doc_id, text from documents").fetchall()
    words = {k: (t or "").encode().lower().split() for k, t in docs}
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for k, w in words.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op3_jaccard_join(spark, SF).collect()}
    assert got == {k: (len(s), find(k)) for k, s in sets.items()}


def test_leaks_hold_whole_items(spark, con):
    docs, items = con.execute("select doc_id, text from documents").fetchall(), con.execute("select item_id, text from benchmark").fetchall()
    form = lambda t: " ".join((t or "").lower().split())
    want = {(d, i) for d, t in docs for i, b in items if form(b) in form(t)}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op1_decontamination(spark, SF).collect()}
    assert want <= got and len(got - want) <= 1


def _auc(score, label):
    import numpy as np

    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


@pytest.mark.parametrize(
    ("name", "label", "sf", "auc", "caught", "wrong"),
    [("op2_quality", "quality", "sf0.1", 0.95, 0.8, 0.2), ("op10_toxicity", "toxic", "sf0.1", 0.95, 0.8, 0.02), ("op10_toxicity", "toxic", "sf0.01", 0.9, 0.5, 0.05)],
)
def test_held_out(spark, name, label, sf, auc, caught, wrong):
    """On held-out rows: the area under the curve, the share of label 1 that is caught, the share of label 0 that isn't left alone."""
    at = f"/root/testdata/{sf}"
    scored = queries.QUERIES[name](spark, at).cache()
    rows = scored.where("held_out").join(spark.read.parquet(f"{at}/labels.parquet"), "doc_id").select("predicted", "score", label).toPandas()
    assert scored.count() == spark.read.parquet(f"{at}/documents.parquet").count()
    y = rows[label].to_numpy()
    assert _auc(rows.score.to_numpy(), y) >= auc
    assert rows.predicted[y == 1].mean() >= caught and rows.predicted[y == 0].mean() <= wrong


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        assert before * 0.5 < docs.count() <= before, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(packed.doc_id) == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
