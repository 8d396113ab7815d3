"""Data flow in code, on programs built from the parts table, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import code, usage
from ..session import table
from ..sources.logs import write_verified
from .base import query

# Six programs: ** of a dictionary, positional arguments and a chained method, a command-line option beside an unknown **,
# a parameter's default, another library's name, a variable with two values.
PROGRAMS = [
    "import tools\nd = dict(size={s}, seed=7)\ntools.Model(**d)\n",
    "from tools.core import Model as M\nM({s}, 'x', seed=1).fit(rows, y)\n",
    "import tools\np.add_argument('-n', '--n-size', default={s})\na = p.parse_args()\ntools.Model(size=a.n_size, **extra)\n",
    "import tools\ndef run(k={s}):\n    return tools.Model(size=k, **{{'seed': k}})\n",
    "from gadgets import tools_like\ntools_like({s})\n",
    "try:\n    import tools\nexcept ImportError:\n    tools = None\nk = {s}\nk = {s} + 1\nm = tools.Model(size=k)\nm = m.fit(rows)\nprint(m.size_)\nm.predict(rows)\n",
]
LIBRARY = "class Model:\n    def __init__(self, size=10, label=None, seed=0):\n        pass\n"

# What each program does: kind 0 is a constructor call, 1 a method.
OUTCOMES = """
SELECT p_partkey, p_brand, 'tools.Model' AS name, NULL AS method, [['seed', '7'], ['size', s]] AS kwargs, ['seed', 'size'] AS followed, FALSE AS star FROM p WHERE shape = 0
UNION ALL SELECT p_partkey, p_brand, 'tools.Model', NULL, [['label', '''x'''], ['seed', '1'], ['size', s]], [], FALSE FROM p WHERE shape = 1
UNION ALL SELECT p_partkey, p_brand, 'tools.Model', 'fit', [['#0', '<expr>'], ['#1', '<expr>']], [], FALSE FROM p WHERE shape = 1
UNION ALL SELECT p_partkey, p_brand, 'tools.Model', NULL, [['size', s]], ['size'], TRUE FROM p WHERE shape = 2
UNION ALL SELECT p_partkey, p_brand, 'tools.Model', NULL, [['seed', s], ['size', s]], ['seed', 'size'], FALSE FROM p WHERE shape = 3
UNION ALL SELECT p_partkey, p_brand, 'tools.Model', NULL, [['size', '<expr>']], [], FALSE FROM p WHERE shape = 5
UNION ALL SELECT p_partkey, p_brand, 'tools.Model', unnest(['fit', 'predict']), [['#0', '<expr>']], [], FALSE FROM p WHERE shape = 5
"""
PARTS = "p AS (SELECT p_partkey, p_brand, p_size::VARCHAR AS s, p_partkey % 6 AS shape FROM part)"


def _programs(spark: SparkSession, sf: str) -> DataFrame:
    texts = F.array(*[F.lit(t.replace("{{", "{").replace("}}", "}")) for t in PROGRAMS])
    text = F.replace(F.get(texts, (F.col("p_partkey") % len(PROGRAMS)).cast("int")), F.lit("{s}"), F.col("p_size").cast("string"))
    return table(spark, sf, "part").select("p_partkey", "p_brand", F.concat(F.lit("src/part"), F.col("p_partkey").cast("string"), F.lit(".py")).alias("path"), text.alias("text"))


def _signatures(spark: SparkSession) -> DataFrame:
    return code.read_signatures(spark.createDataFrame([(LIBRARY,)], "text string"), "text")


def _pairs(c: str):
    return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


@query(f"""WITH {PARTS}, c AS ({OUTCOMES})
SELECT p_partkey, name, method, list_aggregate(list_transform(kwargs, lambda x: x[1] || '=' || x[2]), 'string_agg', ',') AS kwargs, array_to_string(followed, ',') AS followed, star FROM c""")
def code_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Calls with the values that reach them: through names, defaults, options and unpacked dictionaries."""
    files = _programs(spark, sf)
    facts = write_verified(code.code_facts(files, "text", "tools"), "facts")
    calls = code.resolved_calls(facts, "tools", signatures=_signatures(spark))
    found = files.select("p_partkey", F.sha2("text", 256).alias("blob")).join(calls.hint("merge"), "blob")
    name = F.regexp_replace("name", r"\.core\.", ".")
    return found.select("p_partkey", name.alias("name"), "method", _pairs("kwargs").alias("kwargs"), F.array_join("followed", ",").alias("followed"), "star")


@query(f"""WITH {PARTS}, c AS ({OUTCOMES}), u AS (
  SELECT p_brand, count(*) FILTER (WHERE method IS NULL) AS n_constructor_calls, bool_or(star) AS star_kwargs, list_sort(list(DISTINCT method) FILTER (WHERE method IS NOT NULL)) AS methods,
    bool_or(method = 'fit' AND len(kwargs) = 2) AS learns_target FROM c GROUP BY p_brand)
SELECT p.p_brand, CASE WHEN bool_or(shape <> 4) THEN 'calls' ELSE 'through another' END AS "use", count(*) AS n_files, count(*) AS n_files_naming, bool_or(shape <> 4) AS imports, bool_or(shape = 5) AS guarded,
  coalesce(any_value(n_constructor_calls), 0) AS n_constructor_calls, coalesce(any_value(star_kwargs), FALSE) AS star_kwargs, coalesce(any_value(learns_target), FALSE) AS learns_target,
  array_to_string(coalesce(any_value(methods), []), ',') AS methods, CASE WHEN bool_or(shape = 5) THEN 'size_' ELSE '' END AS attributes, CASE WHEN bool_or(shape = 4) THEN 'gadgets.tools_like' ELSE '' END AS elsewhere,
  CASE WHEN bool_or(shape = 2) THEN 'options' ELSE '' END AS signals, concat_ws(',', CASE WHEN bool_or(shape = 4) THEN 'gadgets' END, CASE WHEN bool_or(shape <> 4) THEN 'tools' END) AS modules
FROM p LEFT JOIN u USING (p_brand) GROUP BY p.p_brand""")
def project_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Each brand is a project whose files are its parts."""
    got = usage.project_usage(_programs(spark, sf), "p_brand", "path", "text", "tools", _signatures(spark), signals={"options": "add_argument"})
    text = lambda c: F.array_join(c, ",").alias(c)
    return got.select("p_brand", "use", "n_files", "n_files_naming", "imports", "guarded", "n_constructor_calls", "star_kwargs", "learns_target", text("methods"), text("attributes"), text("elsewhere"), text("signals"), text("modules"))


@query(f"""WITH {PARTS}, c AS ({OUTCOMES}), a AS (
  SELECT p_brand, unnest(kwargs) AS kv, followed FROM c WHERE method IS NULL), v AS (SELECT p_brand, kv[1] AS arg, kv[2] AS value, list_contains(followed, kv[1]) AS f FROM a)
SELECT p_brand, arg, array_to_string(list_sort(coalesce(list(DISTINCT value) FILTER (WHERE NOT f AND value <> '<expr>'), [])), ',') AS written,
  array_to_string(list_sort(coalesce(list(DISTINCT value) FILTER (WHERE f), [])), ',') AS followed, count(*) FILTER (WHERE value = '<expr>') AS n_unresolved FROM v GROUP BY p_brand, arg""")
def argument_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values written at a call and values followed to it, for each project and argument."""
    files = _programs(spark, sf)
    facts = write_verified(code.code_facts(files, "text", "tools"), "facts")
    calls = code.resolved_calls(facts, "tools", signatures=_signatures(spark))
    placed = files.select("p_brand", F.sha2("text", 256).alias("blob")).join(calls.hint("merge"), "blob")
    got = usage.argument_values(placed, "p_brand")
    return got.select("p_brand", "arg", F.array_join("written", ",").alias("written"), F.array_join("followed", ",").alias("followed"), F.col("n_unresolved").cast("long").alias("n_unresolved"))
