"""Values followed through code, bracketed calls, and the rollup of a project."""

from pyspark.sql import functions as F

from quarrymill.operators import code, usage

LIBRARY = "class Tool:\n    def __init__(self, size=10, *, seed=0):\n        pass\n\nclass Net(Tool):\n    def __init__(self, width, depth=2, kind='a'):\n        pass\n"


def flow(spark, text, **options):
    files = spark.createDataFrame([(text,)], "t string")
    signatures = code.read_signatures(spark.createDataFrame([(LIBRARY,), ("not python (",), (None,)], "t string"), "t")
    rows = code.resolved_calls(code.code_facts(files, "t", "lib"), "lib", signatures=signatures, **options).orderBy("seq").collect()
    return [(r["name"], r["method"], r["kwargs"], r["followed"], r["star"], r["uncertain"]) for r in rows]


CASES = [
    ("lib.Net(3, k, kind='b')", {"width": "3", "depth": "<expr>", "kind": "'b'"}, [], False),
    ("lib.Net(3, *rest, depth=1)", {"width": "3", "depth": "1"}, [], False),
    ("d = {'depth': 4, 'width': w}\nlib.Net(1, **d)", {"width": "1", "depth": "4"}, ["depth"], False),
    ("lib.Net(**{'depth': 4}, **dict(depth=5, kind='c'))", {"depth": "4", "kind": "'c'"}, [], False),
    ("d = {}\nd = {'a': 1}\nlib.Net(**d)", {}, [], True),
    ("d = {**e, 'a': 1}\nlib.Net(**d)", {}, [], True),
    ("def f(k=5, *, s):\n    lib.Net(width=k, depth=s)", {"width": "5", "depth": "<expr>"}, ["width"], False),
    ("f = lambda k=2: lib.Net(k)", {"width": "2"}, ["width"], False),
    ("p.add_argument('-n', '--n-width', default=7)\nargs = p.parse_args()\nlib.Net(args.n_width)", {"width": "7"}, ["width"], False),
    ("@click.option('--w', dest='width', default=1)\ndef f(): pass\nlib.Net(opts.width)", {"width": "1"}, ["width"], False),
    ("a = b = c = 3\nd = a\ne = d\nlib.Net(e, depth=d, kind=f)", {"width": "3", "depth": "3", "kind": "<expr>"}, ["depth", "width"], False),
    ("a = 3\nb = a\nc = b\nd = c\nlib.Net(d)", {"width": "<expr>"}, [], False),
    ("a = 3\nb = 3\nc = a\nc = b\nlib.Net(c)", {"width": "3"}, ["width"], False),
    ("a = 3\na += 1\nlib.Net(a)", {"width": "<expr>"}, [], False),
    ("a = 3\nfor a in x: pass\nlib.Net(a)", {"width": "<expr>"}, [], False),
    ("a, b = 1, 2\nlib.Net(a)", {"width": "<expr>"}, [], False),
    ("class A:\n    def __init__(self, k=9):\n        self.k = k\n    def go(self):\n        lib.Net(self.k, depth=-1)", {"width": "9", "depth": "-1"}, ["width"], False),
    ("with open(f) as a: lib.Net(a, 2)", {"width": "<expr>", "depth": "2"}, [], False),
    ("if (a := 4): lib.Net(a)", {"width": "4"}, ["width"], False),
]


def test_arguments(spark):
    signatures = code.read_signatures(spark.createDataFrame([(LIBRARY,), ("not python (",), (None,)], "t string"), "t")
    files = spark.createDataFrame([(i, "import lib\n" + c[0]) for i, c in enumerate(CASES)], "i int, t string")
    calls = code.resolved_calls(code.code_facts(files, "t", "lib").cache(), "lib", signatures=signatures).where("method is null")
    rows = files.select("i", F.sha2("t", 256).alias("blob")).join(calls, "blob").collect()
    got = {r["i"]: (r["kwargs"], r["followed"], r["star"]) for r in rows}
    assert len(rows) == len(CASES)
    for i, (text, *want) in enumerate(CASES):
        assert got[i] == tuple(want), text


def test_objects(spark):
    text = "from lib import Tool as T\nm = T(1).fit(x)\nother = m.fit(y)\nother.go()\nT().fit(x).end()\nz = 1\nz = T()\nz.run()\n%magic\nlib = m\nimport lib\nlib.max()\n"
    got = flow(spark, text, known=["Tool"])
    assert [(g[0], g[1], g[5]) for g in got] == [
        ("lib.Tool", "fit", False), ("lib.Tool", None, False), ("lib.Tool", "fit", False), ("lib.Tool", "go", False),
        ("lib.Tool", "end", False), ("lib.Tool", "fit", False), ("lib.Tool", None, False), ("lib.Tool", None, False), ("lib.Tool", "run", True),
    ]
    assert not [g for g in flow(spark, text, own=["fit"]) if g[1] == "run"]


def test_names(spark):
    text = "import lib.sub as s, lib.core as lib\nfrom lib import *\nfrom other import lib_like, x\nm = lib.Tool()\nprint(m.size_, s.name, x)\nlib_like(1)\n"
    facts = code.code_facts(spark.createDataFrame([(text,)], "t string"), "t", "lib")
    got = sorted((r["kind"], r["name"]) for r in code.resolved_names(facts, "lib").collect())
    assert got == [
        ("attribute", "lib.core.Tool.size_"), ("elsewhere", "other.lib_like"), ("form", "from lib import *"), ("form", "import lib.core as lib"), ("form", "import lib.sub"),
        ("name", "lib.core.Tool"), ("name", "lib.sub.name"),
    ]


def test_project(spark):
    files = [
        ("p", "a.py", "try:\n    import lib\nexcept ImportError:\n    lib = None\nlib.Tool(size=1).fit(x, y)\nlib.Tool(size=1)\nlib.Tool(**k)\n"), ("p", "b.py", "# LIB only\n"), ("p", "c.py", None), ("p", "d.py", "lib ((\n"),
        ("q", "src/wrap.py", "from wrap import lib_fit\nlib_fit()\n"), ("q", "e.py", "import carry\ncarry.go('lib')\n"), ("r", "f.py", "import os\n"), ("s", "g.py", "def f():\n    from lib import Tool\n"), ("t", "h.py", "from away import lib_fit\nlib_fit()\n"),
    ]
    df = spark.createDataFrame(files, "e string, path string, t string")
    rows = usage.project_usage(df, "e", "path", "t", "lib", signals={"wild": r"\*\*"}, carriers={"Carry": ("carry", "'lib'"), "Other": ("os", "'lib'")})
    got = {r["e"]: r.asDict() for r in rows.collect()}
    p = got["p"]
    assert (p["use"], p["n_files"], p["n_files_unread"], p["n_files_naming"], p["n_files_unparsed"]) == ("calls", 4, 1, 3, 1 + 0)
    assert (p["called"], p["methods"], p["n_constructor_calls"], p["star_kwargs"], p["learns_target"], p["guarded"], p["signals"], p["calling_files"]) == (["lib.Tool"], ["fit"], 3, True, True, True, ["wild"], ["a.py"])
    assert (got["q"]["use"], got["q"]["elsewhere"], got["q"]["through"]) == ("through another", [], ["Carry"])
    assert (got["r"]["use"], got["s"]["use"], got["s"]["lazy"], got["s"]["names"]) == ("no mention", "imports only", True, [])
    assert (got["t"]["use"], got["t"]["elsewhere"]) == ("through another", ["away.lib_fit"])


def test_configurations(spark):
    calls = [("p", "lib.T", None, {"a": "1", "b": "2"}, ["b"], False), ("p", "lib.T", None, {"b": "2", "a": "1"}, [], False), ("p", "lib.T", None, {"a": "<expr>"}, [], True), ("p", "lib.T", "fit", {"a": "3"}, [], False)]
    df = spark.createDataFrame(calls, "e string, name string, method string, kwargs map<string,string>, followed array<string>, star boolean")
    assert sorted((r["n"], r["star"], sorted(r["kwargs"].items())) for r in usage.configurations(df, "e").collect()) == [(1, True, [("a", "<expr>")]), (2, False, [("a", "1"), ("b", "2")])]
    got = {r["arg"]: (r["written"], r["followed"], r["n_unresolved"]) for r in usage.argument_values(df, "e").collect()}
    assert got == {"a": (["1"], [], 1), "b": (["2"], ["2"], 0)}
    assert df.select(F.count("*")).first()[0] == 4


EXCERPT = """import os
import lib
from plot import scatter

class Runner:
    def reduce_rows(self, rows):
        # lib is quick
        if rows:
            model = lib.Tool(size=2)
        return model.fit_transform(rows)

def other():
    pass

out = Runner().reduce_rows(data)
noise = 1
scatter(out.x, out.y)
print(noise)
"""


def test_excerpts(spark):
    windows = {"call": (0, 0, 0.8), "result": (0, 0, 0.9), "mention": (0, 0, 1.0)}
    files = [("p", "a.py", EXCERPT), ("p", "copy.py", EXCERPT), ("p", "b.py", "import lib\n" + "\n".join(f"lib.go({i})" for i in range(50))), ("p", "c.py", None), ("q", "d.py", "nothing\n"), ("r", "e.py", "x = lib\n")]
    df = spark.createDataFrame(files, "e string, path string, t string")
    show = lambda budget: {(r["e"], r["path"]): r for r in code.project_excerpts(df, "e", "path", "t", "lib", budget, windows, r"\.fit_transform\(").collect()}
    got = show(100_000)
    assert set(got) == {("p", "a.py"), ("p", "b.py"), ("r", "e.py")}
    assert got["p", "a.py"]["excerpt"] == (
        "import os\nimport lib\nfrom plot import scatter\n...\nclass Runner:\n    def reduce_rows(self, rows):\n...\n            model = lib.Tool(size=2)\n...\nout = Runner().reduce_rows(data)\n...\nscatter(out.x, out.y)"
    )
    assert got["r", "e.py"]["excerpt"] == "x = lib" and got["p", "b.py"]["excerpt"].count("lib.go") == 50
    small = show(200)
    assert {k for k in small if k[0] == "p"} == {("p", "a.py"), ("p", "b.py")} and all(r["used"] <= 200 for r in small.values())
    assert "lib.go(0)" in small["p", "b.py"]["excerpt"] and "lib.Tool" in small["p", "a.py"]["excerpt"]
