"""Steps whose cost must grow no faster than their input."""

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_code_facts_passes_no_texts_through_the_driver(spark):
    """Every side of its joins has a row for each text or fact, however small the file they come from."""
    got = plan(entry_point.queries()["code_facts"](spark, SF))
    assert "BroadcastExchange" not in got
    assert "MapInPandas" not in got  # the facts are read from a table, once written


def test_knn_is_exact_and_its_tiles_are_tasks(spark):
    """Copies tie and go by key, a vector that isn't finite takes no part; a tile gives a row one list and stays a task of its own."""
    import numpy as np

    from quarrymill.operators import vectors

    rng = np.random.default_rng(3)
    v = rng.standard_normal((900, 8)).astype("float32")
    v[450:] = v[:450]
    v[7, 2] = np.nan
    df = spark.createDataFrame([(i * 3, x.tolist()) for i, x in enumerate(v)], "id long, v array<float>")
    found = vectors.knn(df, "id", "v", 5, block_rows=300)
    assert "REPARTITION_BY_NUM" in plan(found)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    u = v.astype("float64")
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    for i in range(900):
        d = 1 - np.einsum("ij,ij->i", np.repeat(u[i : i + 1], 900, axis=0), u)
        d[i] = np.inf
        order = [j for j in np.lexsort((np.arange(900), d)) if np.isfinite(d[j])][:5]
        assert got.get(i * 3, []) == [j * 3 for j in order]


def test_fuzzy_graph_weighs_rows_together(spark):
    """No call of Python for each row; lists of any length; the neighbours are computed once."""
    from quarrymill.operators import vectors

    near = spark.createDataFrame([(1, 2, 0.1), (1, 3, 0.3), (1, 4, 0.9), (2, 1, 0.1), (3, 1, 0.2), (3, 2, 0.2)], "id long, neighbour long, distance double")
    found = vectors.fuzzy_graph(near, "id")
    assert "FlatMapGroupsInPandas" not in plan(found) and plan(found).count("MapInArrow") == 1
    got = {(r["a"], r["b"]): r["weight"] for r in found.collect()}
    assert set(got) == {(1, 2), (2, 1), (1, 3), (3, 1), (1, 4), (4, 1), (2, 3), (3, 2)} and all(0 < w <= 1 for w in got.values())
    assert got[1, 2] == got[2, 1] == 1.0 and got[3, 1] == 1.0


def test_arg_report_reads_its_summary_once(spark):
    from quarrymill.operators import rollup

    got = plan(entry_point.queries()["arg_report"](spark, SF))
    assert got.count("FileScan") == 1
    summary = spark.createDataFrame([(1, "a", ["x", "y"], 0), (2, "a", ["y"], 2), (3, "a", [], 1), (4, "b", [], 0)], "e long, arg string, written array<string>, n_unresolved long")
    rows = {r["arg"]: tuple(r)[1:] for r in rollup.arg_report(summary, 1).collect()}
    assert rows == {"a": (3, 2, 1, ["y x2"]), "b": (1, 0, 0, [])}


def test_bracket_calls_deals_out_a_small_file(spark):
    assert "REPARTITION_BY_NUM" in plan(entry_point.queries()["bracket_calls"](spark, SF))


def test_project_excerpts_calls_python_for_batches(spark):
    got = plan(entry_point.queries()["project_excerpts"](spark, SF))
    assert "FlatMapGroupsInPandas" not in got and "MapInArrow" in got


def test_embedding_reads_a_text_once(spark):
    """The words' places are the element of an array that a lambda takes, not an expression inside the lambda of each dimension."""
    from quarrymill.operators import batches

    df = spark.createDataFrame([("a b, A c",), ("",), (None,)], "t string").select("t", batches.hashed_embedding("t", 4).alias("v"))
    assert "transform(array(transform(filter(split(" in plan(df)
    got = {r["t"]: r["v"] for r in df.collect()}
    assert sum(got["a b, A c"]) == 4 and max(got["a b, A c"]) >= 2 and got[""] == [0.0] * 4


def test_decontamination_hashes_only_windows_of_benchmark_tokens(spark):
    """Windows with a token that no benchmark text has are neither hashed nor joined; all others are kept, with their places."""
    from pyspark.sql import functions as F

    from quarrymill.llm import decontamination as D

    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    docs = spark.createDataFrame([("zebra - one two three four five six seven eight nine yak one two",), ("one two",), ("",), (None,)], "t string")
    for form in D.FORMS:
        sketch = D.token_sketch(bench, "item_id", "text", form)
        assert len(sketch) == D.SLOTS and 0 < sketch.count(b"1") <= 10
        tokens = D.with_tokens(docs, "t").select("t", D.FORMS[form])
        rows = tokens.select("t", D.known_windows(form, 8, sketch).alias("w"), D.windows(form, F.lit(8)).alias("all")).collect()
        got = {r["t"]: r for r in rows}
        long = got["zebra - one two three four five six seven eight nine yak one two"]
        assert [(w["doc_at"], w["hash"]) for w in long["w"]] == [(i, long["all"][i]) for i in (1, 2)] and len(long["all"]) == 6
        assert not got["one two"]["w"] and not got[""]["w"] and not got[None]["w"]
