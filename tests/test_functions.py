"""Scalar functions and operators on literal edge rows."""

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.operators import code, deps, entity, relational, rollup
from quarrymill.sources import logs


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("rock-mill>=0.5,<1", [">=0.5,<1"]), ("rock_mill==0.5.*", ["==0.5.*"]), ("Rock.Mill ~= 0.5", ["~=0.5"]), ("rock-mill", [""]), ("rock-mill[plot] @ git+x", ["from source"]),
        ("rock-mill=0.5=py_0", ["==0.5"]), ("my-rock-mill==1", []), ("rock-mill-extra", []), ("rock-mill==1\nrock-mill>2", ["==1", ">2"]), ("rock-mill !=0.4", ["!=0.4"]),
    ],
)
def test_specifiers(spark, text, want):
    assert one(spark, T.specifiers(F.col("t"), "rock-mill"), t=text) == want


@pytest.mark.parametrize(
    ("spec", "kind", "anchor"),
    [
        ("", "Any version", ""), ("from source", "From source", ""), (">=1", "Lower bound", "1"), ("<2", "Upper bound", "2"), (">=1,<2", "Bounded", "1"), ("==1", "One version", "1"),
        ("==1.*", "Compatible", "1.*"), ("~=1", "Compatible", "1"), ("^1", "Compatible", "1"), ("!=1", "Any version", "1"), ("==1,!=1.1", "One version", "1"), ("===1", "One version", "1"),
        ("<1,>=0.5", "Bounded", "0.5"), ("==1.0,>=0.5", "Lower bound", "0.5"), ("!=2,<3", "Upper bound", "3"), (None, None, None),
    ],
)
def test_version_kind(spark, spec, kind, anchor):
    got = one(spark, T.version_kind(F.col("s")), s=spec)
    assert (got and (got["kind"], got["anchor"])) == (kind and (kind, anchor))


def test_strip_and_comments(spark):
    assert one(spark, T.ustrip(F.col("t")), t="\t  x y\n") == "x y"
    assert one(spark, T.strip_comment(F.col("t")), t="a==1 # why") == "a==1"
    assert one(spark, T.strip_comment(F.col("t")), t="a#b") == "a#b"
    assert one(spark, T.most_specific(F.array(F.lit(""), F.lit("from source"), F.lit(">=1")))) == ">=1"
    assert one(spark, T.imported_modules(F.col("t")), t="import a.b as c, d\nfrom e.f import g\nfrom . import h") == ["a", "d", "e"]
    assert one(spark, T.replace_magics(F.col("t")), t="  !ls\nx") == "  pass\nx"


@pytest.mark.parametrize(
    ("lines", "want"),
    [(["a==1  # via x, y"], ["x", "y"]), (["a==1", "    # via", "    #   x", "    #   -r f.in", "b==2", "# via z"], ["x", "-r f.in"]), (["a==1", "b"], []), (["a==1 # via -c f.in"], [])],
)
def test_via(spark, lines, want):
    assert one(spark, T.via_notes(F.array(*[F.lit(x) for x in lines]), F.lit(0))) == want


def test_decode(spark):
    rows = spark.createDataFrame([("héé".encode("utf-16"),), (b"\xef\xbb\xbfok",), (b"a\xff",), (b"x\x00y",), (None,)], "b binary")
    assert [r[0] for r in rows.select(T.decode_text(F.col("b"))).collect()][:3] == ["héé", "ok", "a�"]
    assert [r[0] for r in rows.select(T.store_status(F.col("b"), 100)).collect()] == ["ok", "ok", "ok", "binary", "missing"]


def test_log_with_a_cut_end(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n{"k": 2}\n{"k": 3')
    assert sorted(r[0] for r in logs.read_log(spark, str(tmp_path / "a.jsonl"), "k long").collect()) == [1, 2]
    (tmp_path / "b.jsonl").write_text('{"k": 1}\n{"k"\n{"k": 3}\n')
    with pytest.raises(Exception, match="broken line"):
        logs.read_log(spark, str(tmp_path / "b.jsonl"), "k long").collect()


def test_notebooks(spark):
    new = '{"cells": [{"cell_type": "code", "source": ["a\\n", "b"]}, {"cell_type": "markdown", "source": ["x"]}, {"cell_type": "code", "source": ["c"]}]}'
    old = '{"worksheets": [{"cells": [{"cell_type": "code", "input": ["d"]}]}]}'
    rows = spark.createDataFrame([(new,), (old,), ("[]",)], "t string")
    assert [r[0] for r in rows.select(logs.flatten_cells(F.col("t"))).collect()] == ["a\nb\n# ---\nc", "d", None]


def test_families(spark):
    rows = [("a", None, False, 5, 1), ("b", "a", True, 1, 2), ("c", "a", True, 12, 2), ("d", "gone", True, 3, 1), ("e", "gone", True, 3, 2), ("f", None, True, None, 1)]
    df = spark.createDataFrame(rows, "k string, p string, fork boolean, stars int, t int").withColumn("t", F.timestamp_seconds("t"))
    got = {r["k"]: r["n_forks"] for r in entity.representatives(df, "k", "p", "fork", "stars", "t", 10).collect()}
    assert got == {"a": 2, "c": 0, "e": 1, "f": 0}


def test_answers(spark):
    rows = [
        (1, "`the quick  fox`", "Speed", "see the quick fox run"), (1, "short", "Other", "short"), (2, "not there at all", "Size", "nothing"), (3, "a quoted line", "Other", "a quoted line"),
        (4, "The Quick fox", "Speed", "see the quick fox run"), (4, "see the quick", "Can't tell", "see the quick fox run"),
    ]
    df = spark.createDataFrame(rows, "e int, q string, a string, s string")
    got = {r["e"]: (r["kept"], r["dropped"]) for r in entity.verified_answers(df, "e", "q", "a", "s").collect()}
    assert got == {1: (["Speed"], ["Other"]), 2: (["Can't tell"], ["Size"]), 3: (["Other"], []), 4: (["Can't tell"], ["Speed"])}


def test_classified_files(spark):
    rows = [
        (1, "a/b/req.txt", True, True, True, "dev", 5, ">=1", False), (1, "req.lock", True, True, None, "required", 90, "==9", False), (1, "x.txt", False, True, True, "required", 50, "==3", False),
        (2, "u.lock", True, False, False, "required", 3, "==1", False), (3, "big.txt", False, False, None, None, 2, None, False), (4, "none.txt", False, True, None, None, 2, None, False),
        (5, "env.txt", True, True, True, "required", 40, "==7", True), (5, "deep/er/req.txt", True, True, True, "optional", 4, ">=2", False),
    ]
    df = spark.createDataFrame(rows, "e int, path string, named boolean, whole boolean, direct boolean, scope string, entries int, spec string, dump boolean")
    got = {r["e"]: (r["status"], r["scope"], r["longest"], r["spec"], len(r["declared_in"]), len(r["locked_in"])) for r in rollup.classify_files(df, "e").collect()}
    assert got == {
        1: ("declared", "dev", 5, ">=1", 1, 1), 2: ("lock only", None, None, None, 0, 1), 3: ("unread", None, None, None, 0, 0), 4: ("not found", None, None, None, 0, 0),
        5: ("declared", "required", 40, ">=2", 2, 0),
    }


@pytest.mark.parametrize(
    ("path", "file", "key"),
    [
        ("a/precise.txt", "required", None), ("bench.txt", "dev", None), ("x/dev-requirements.txt", "dev", None), ("extra.txt", "optional", None),
        ("project.dependencies", "required", "required"), ("project.optional-dependencies.x", "optional", "optional"), ("dependency-groups.test", "dev", "dev"), ("build-system.requires", "required", "dev"),
        ("tool.uv.sources.packages", "required", None), ("tool.uv.override-dependencies", "required", None), ("project.urls.home", "required", None),
    ],
)
def test_scopes(spark, path, file, key):
    got = one(spark, F.struct(T.file_scope(F.col("p")).alias("f"), T.key_path_scope(F.col("p")).alias("k")), p=path)
    assert (got["f"], got["k"]) == (file, key)


def test_call_text(spark):
    kwargs = {"a": "<expr>", "b": "x" * 24, "c": "y" * 25, "d": "1", "e": "2"}
    for star, extra, want in ((False, {}, "a=…, b=" + "x" * 24 + ", c=" + "y" * 23 + "…, d=1, e=2"), (True, {}, "a=…, b=" + "x" * 24 + ", c=" + "y" * 23 + "…, d=1, e=2, **…"), (True, {"f": "3"}, "a=…, b=" + "x" * 24 + ", c=" + "y" * 23 + "…, d=1, e=2, f=3, +1 more")):
        df = spark.createDataFrame([("lib.sub.Model", kwargs | extra, star)], "n string, k map<string,string>, s boolean")
        assert df.select(T.call_text(F.col("n"), F.col("k"), F.col("s"))).first()[0] == f"Model({want})"


def test_value_given(spark):
    rows = [(1, "2", False), (1, "2", False), (2, "2", False), (2, "2.0", False), (3, None, False), (4, "<expr>", False), (5, None, True), (6, "2", False), (6, None, True), (7, "2", False), (7, None, False), (8, "2", False), (8, "<expr>", False), (9, "<expr>", False), (9, None, False)]
    df = spark.createDataFrame(rows, "e int, v string, s boolean")
    got = {r["e"]: (r["answer"], r["value"]) for r in rollup.value_given(df, "e", F.col("v"), F.col("s")).collect()}
    assert got == {1: ("VALUE", "2"), 2: ("SEVERAL", None), 3: ("DEFAULT", None), 4: ("UNREADABLE", None), 5: ("UNREADABLE", None), 6: ("VALUE", "2"), 7: ("VALUE", "2"), 8: ("VALUE", "2"), 9: ("UNREADABLE", None)}


def test_requirers(spark):
    rows = [("f", "t", [], False), ("f", "x", ["t"], False), ("g", "t", [], False), ("h", "t", [], False), ("h", "own", ["t"], True), ("i", "x", ["y"], False)]
    df = spark.createDataFrame(rows, "f string, n string, d array<string>, o boolean")
    got = {r["f"]: (r["direct"], r["via"]) for r in deps.requirers(df, "f", "n", "d", "t", "o").collect()}
    assert got == {"f": (False, ["x"]), "g": (True, []), "h": (True, [])}


def test_code(spark):
    text = "import lib.core as c\nfrom lib import Tool as T\nA = 3\nB = A\nm = T(size=B, n=f(x), s='2', v=2.0)\nm.fit(1)\nz = 1\nz = T()\nz.run()\n"
    df = spark.createDataFrame([(text,), ("lib ((",), ("nothing",)], "t string")
    facts = code.code_facts(df, "t", "lib").cache()
    assert facts.where("kind = 'unparsed'").count() == 1
    calls = {(r["name"], r["method"], r["uncertain"]): dict(r["kwargs"]) for r in code.resolved_calls(facts, "lib").collect()}
    assert calls["lib.Tool", "fit", False] == {"#0": "1"} and ("lib.Tool", "run", True) in calls
    assert {"size": "3", "n": "<expr>", "s": "'2'", "v": "2.0"} in [dict(r["kwargs"]) for r in code.resolved_calls(facts, "lib").where("method is null").collect()]


def test_repeated_keys_stop_the_join(spark):
    left, right = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    with pytest.raises(Exception, match="repeated"):
        relational.join_1to1(left, right, "k").collect()


def test_quotes(spark):
    texts = spark.createDataFrame([(1, "one two three  four five six"), (2, "abcdefghij"), (3, None)], "k int, t string")
    quotes = spark.createDataFrame([(1, "wo three four\nfive s"), (2, "bcdefghi"), (3, "abc"), (4, "seven eight nine ten eleven")], "q int, t string")
    got = {tuple(r) for r in entity.contained_quotes(texts, "k", "t", quotes, "q", "t").collect()}
    assert got == {(1, 1), (2, 2)}


def test_halving(spark):
    from quarrymill.operators.batches import map_batches

    def fn(values):
        if "bad" in values:
            raise ValueError("no")
        return [v.upper() for v in values]

    df = spark.createDataFrame([(i, "bad" if i == 3 else "x") for i in range(9)], "k int, v string")
    got = {r["k"]: (r["status"], r["result"], r["error"]) for r in map_batches(df, "k", "v", fn, 4).collect()}
    assert got[3] == ("error", None, "ValueError: no") and all(v == ("ok", "X", None) for k, v in got.items() if k != 3)


def test_balanced_calls(spark):
    text = 'x = fit(a=1, b="t", c=g(d=2, e=h(f=3)), a=2) and fit(n) fit(((deep)))'
    got = code.balanced_calls(spark.createDataFrame([(1, text), (2, None), (3, "fit(")], "k int, t string"), "k", "t", "fit").collect()
    assert [(r["k"], r["position"], r["arguments"]) for r in got] == [(1, 0, 'a=1, b="t", c=g(d=2, e=h(f=3)), a=2'), (1, 1, "n"), (1, 2, "((deep))")]
    assert got[0]["literals"] == {"a": "2", "b": '"t"'} and got[1]["literals"] == {}


def test_line_kinds(spark):
    text = "import m\ndef outer_fn(x):\n    def run():\n        return m.go(x)\n    return run()\nouter_fn(1)\n# m.go()\nm"
    got = code.line_kinds(spark.createDataFrame([(1, text), (2, None)], "k int, t string"), "k", "t", "m").orderBy("at").collect()
    assert [(r["at"], r["kind"]) for r in got] == [(3, "direct"), (7, "mention")]
    text = text.replace("def run", "def inner_fn").replace("return run", "return inner_fn")
    got = code.line_kinds(spark.createDataFrame([(1, text)], "k int, t string"), "k", "t", "m").orderBy("at").collect()
    assert [(r["at"], r["kind"]) for r in got] == [(3, "direct"), (4, "wrapper"), (7, "mention")]


def test_manifest_paths(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": [1, "x"]}, "c": true}'), (2, "not json"), (3, None)], "k int, j string")
    got = {(r["path"], r["value"]) for r in deps.key_paths(df, "k", "j").collect()}
    assert got == {("$.a.b[0]", "1"), ("$.a.b[1]", "x"), ("$.c", "true")}


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5.0), (1, -1.0), (None, None)], "k int, v double")
    assert relational.expect(df, unique=["k"], not_null=["k"], minimum={"v": 0}).first().asDict() == {"n_rows": 3, "null_k": 1, "small_v": 1, "repeated_k": 1}


def test_resume(spark, tmp_path):
    from quarrymill.streaming import ingest

    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(2):
        spark.range(i * 10, i * 10 + 10).selectExpr("id", "id % 3 as k").write.mode("append").parquet(source)
        ingest.ingest(ingest.open_stream(spark, source), sink, str(tmp_path / "c1"))
        ingest.upsert_latest(ingest.open_stream(spark, source), ["k"], ["id"], str(tmp_path / "c2"))
    assert spark.read.parquet(sink).count() == 20
    assert sorted(r["id"] for r in ingest.state(spark, str(tmp_path / "c2")).collect()) == [17, 18, 19]


def test_recode_is_total(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert [r[0] for r in df.select(relational.recode(F.col("c"), {"a": "A"})).collect()] == ["A", None]
    with pytest.raises(Exception, match="no code for"):
        df.select(relational.recode(F.col("c"), {"b": "B"})).collect()


def test_same_keys(spark):
    of = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    for left, right, want in (((), (), (0, 0, True)), (("a", None, "a"), (None, "a"), (0, 0, True)), (("a", "b"), ("a", None), (1, 1, False))):
        assert tuple(relational.same_keys(of(*left), of(*right), "k").first()) == want


def test_typed_arguments(spark):
    for token, value, want in (("2", 2, True), ("2.0", 2, False), ("'2'", 2, False), ("'2'", "2", True), ("True", True, True), ("1", True, False)):
        df = spark.createDataFrame([({"n": token},)], "k map<string,string>")
        assert df.select(rollup.equals_typed(F.col("k"), "n", value)).first()[0] is want


def test_table_specifiers(spark):
    for version, located, want in (("1 . 2", False, "==1.2"), ("*", False, ""), (None, False, ""), ("^1, <2", False, "^1,<2"), ("1", True, "from source")):
        df = spark.createDataFrame([(version, located)], "v string, l boolean")
        assert df.select(T.table_specifier(F.col("v"), F.col("l"))).first()[0] == want


def test_running_sums(spark):
    """A group that holds most rows, a null group, and groups of one row, over many partitions."""
    from quarrymill.operators.prefix import running

    rows = [("hot" if i % 5 else None if i % 2 else f"g{i}", i, i % 7) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int, v int").repartition(9)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["o"]: (r["total"], r["place"]) for r in running(df, ["g"], ["o"], {"total": F.col("v"), "place": F.lit(1)}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sums, places = {}, {}
    for g, o, v in rows:
        sums[g], places[g] = sums.get(g, 0) + v, places.get(g, 0) + 1
        assert got[o] == (sums[g], places[g])


def test_manifests_and_locks(spark):
    """Shapes of files that lines can't tell apart."""
    files = [
        ("a", "blocks/requirements.txt", "Pack_Age[extra]>=1,<2\n"), ("b", "requirements-frozen.txt", "pack-age==1\n"), ("c", "reqs.txt", "# Autogenerated by x\npack.age==2\n    # via -r in.txt\n"),
        ("d", "setup.py", "setup(\n" + "x\n" * 60 + "tests_require=['pack-age'])\n"), ("e", "r.txt", "git+https://github.com/me/pack.git\n"), ("f", "pyproject.toml", "broken = [\n pack-age\n"),
        ("g", "poetry.lock", "[[package]]\nname='pack-age'\n[package.dependencies]\nx='1'\n[[package]]\nname='Top_It'\n[package.dependencies]\nPack_Age='>=1'\n"),
        ("h", "pdm.lock", "[[package]]\nname='pack-age'\n[[package]]\nname='own'\ndependencies=['pack-age>=1']\n[package.source]\nvirtual='.'\n"), ("i", "Pipfile.lock", '{"default": {"pack-age": {}}, "develop": {}}'),
        ("j", "Pipfile", "[dev-packages]\npack-age={git='https://x'}\n"), ("k", "pyproject.toml", "[tool.uv.sources]\npack-age={path='x'}\n"), ("l", "a.txt", "pack-age-extra\nnot-pack-age\n# pack-age\n"), ("m", "deep/b.txt", None),
        ("n", "a.txt", "pack-age\n"), ("n", "deep/b.lock", "pack-age==9\n"),
    ]
    df = spark.createDataFrame(files, "e string, path string, text string")
    got = {r["e"]: (r["status"], r["scope"], r["spec"], r["longest"], r["via"]) for r in deps.declarations(df, "e", "pack-age", ["own-core"], "me/pack").collect()}
    assert got == {
        "a": ("declared", "required", ">=1,<2", 1, []), "b": ("lock only", None, None, None, []), "c": ("declared", "required", "==2", 1, []), "d": ("declared", "dev", "", None, []),
        "e": ("declared", "required", "from source", 1, []), "f": ("declared", "required", "", 2, []), "g": ("lock only", None, None, None, ["top-it"]), "h": ("declared", None, None, None, []),
        "i": ("lock only", None, None, None, []), "j": ("declared", "dev", "from source", None, []), "k": ("not found", None, None, None, []), "l": ("not found", None, None, None, []),
        "m": ("unread", None, None, None, []), "n": ("declared", "required", "", 1, []),
    }


def test_metadata_requirements(spark):
    df = spark.createDataFrame([(1, ["pack-age>=1 ; extra == 'x'"]), (2, ["pack-age @ https://x"]), (3, ["other"]), (4, None)], "k int, r array<string>")
    got = {r["k"]: (r["status"], r["scope"], r["spec"], r["kind"]) for r in deps.listed_requirement(df, "k", "r", "pack-age").collect()}
    assert got == {1: ("declared", "optional", ">=1", "Lower bound"), 2: ("declared", "required", "from source", "From source"), 3: ("not found", None, None, None), 4: ("not found", None, None, None)}


def test_spectral_layout(spark):
    """Against numpy's eigenvectors on a ring of three loosely linked groups with distinct sizes."""
    import numpy as np

    from quarrymill.operators import vectors

    sizes, edges, at = (6, 9, 12), [], 0
    for n in sizes:
        edges += [(at + i, at + j, 1.0) for i in range(n) for j in range(i)]
        at += n
    edges += [(0, 6, 0.2), (7, 15, 0.1)]
    w = np.zeros((at, at))
    for a, b, x in edges:
        w[a, b] = w[b, a] = x
    graph = spark.createDataFrame([(a, b, float(w[a, b])) for a in range(at) for b in range(at) if w[a, b]], "a long, b long, weight double")
    rng = np.random.default_rng(1)
    start = spark.createDataFrame([(i, *map(float, rng.normal(size=2))) for i in range(at + 1)], "k long, x double, y double")
    got = vectors.layout_spectral(graph, start, "k", rounds=8, steps=4).toPandas().set_index("k").sort_index()
    assert tuple(got.loc[at]) == (0.0, 0.0)  # no edges
    d = w.sum(axis=1)
    _, v = np.linalg.eigh(w / np.sqrt(np.outer(d, d)))
    mine = got.loc[: at - 1].to_numpy() * np.sqrt(d)[:, None]
    q, _ = np.linalg.qr(mine)
    assert np.linalg.svd(q.T @ v[:, -3:-1])[1].min() > 0.99
