"""Dependency files and bracketed calls built from the parts table, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import code, deps
from ..session import spread, table
from .base import query

# Ten dependency files by size, at the root or below: a list, a nested list, a frozen lock, an address, a compiled list, a
# setup file, an environment that was written out, a manifest, a lock with its requirers, a file that doesn't name the package.
FILES = [
    ("reqs-{s}.txt", "quarry_mill>=0.{s}  # ours\nplain==1.0\n# quarry-mill\n-r more.txt\n"),
    ("blocks/require-{s}.txt", "Quarry.Mill==1.{s} ; python_version > '3'\n"),
    ("requirements-{s}-frozen.txt", "quarry-mill==2.{s}\nquarry-core==1.0\n"),
    ("deep/dev-{s}.txt", "git+https://github.com/quarry/mill.git\n"),
    ("compiled-{s}.txt", "# This file is autogenerated by a tool\nquarry-mill==3.{s}\n    # via\n    #   foo\n    #   Bar_Baz (extra)\nfoo==1\n"),
    ("p{s}/setup.py", "setup(\n  install_requires=['a'],\n  extras_require={'x': ['quarry-mill<{s}']},\n)\n"),
    ("env-{s}.yml", "dependencies:\n  - python=3.9\n  - quarry-mill=0.{s}=py_0\n  - pip:\n    - quarry-core==1\n"),
    ("m{s}/pyproject.toml", "[project]\ndependencies = ['other']\n[project.optional-dependencies]\nx = ['quarry-mill~=1.{s}']\n[tool.poetry.group.test.dependencies]\nquarry-mill = '^1'\n"),
    ("l{s}/uv.lock", "[[package]]\nname = 'quarry-mill'\n[[package]]\nname = 'Top.Level'\ndependencies = [{ name = 'quarry_mill' }]\n"),
    ("none-{s}.txt", "other==1\n"),
]


@query("""
WITH f AS (SELECT DISTINCT p_brand || ' ' || p_type AS entity, p_size AS n, p_size::VARCHAR AS s, p_size % 10 AS shape, p_size % 40 <> 19 AS whole FROM part),
x AS (SELECT *, CASE shape WHEN 0 THEN 'reqs-' || s || '.txt' WHEN 1 THEN 'blocks/require-' || s || '.txt' WHEN 2 THEN 'requirements-' || s || '-frozen.txt' WHEN 3 THEN 'deep/dev-' || s || '.txt' WHEN 4 THEN 'compiled-' || s || '.txt'
    WHEN 5 THEN 'p' || s || '/setup.py' WHEN 6 THEN 'env-' || s || '.yml' WHEN 7 THEN 'm' || s || '/pyproject.toml' WHEN 8 THEN 'l' || s || '/uv.lock' ELSE 'none-' || s || '.txt' END AS path,
  whole AND shape <> 9 AS named, whole AND shape IN (0, 1, 3, 5, 6, 7) AS direct, CASE WHEN shape IN (5, 7) THEN 'optional' WHEN shape = 3 THEN 'dev' ELSE 'required' END AS scope,
  CASE shape WHEN 0 THEN '>=0.' || s WHEN 1 THEN '==1.' || s WHEN 3 THEN 'from source' WHEN 5 THEN '<' || s WHEN 6 THEN '==0.' || s WHEN 7 THEN '~=1.' || s END AS spec,
  CASE shape WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 3 THEN 1 WHEN 6 THEN 4 END AS entries, CASE shape WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 3 THEN 0 WHEN 6 THEN 3 END AS pinned, shape = 6 AS dump,
  CASE shape WHEN 4 THEN ['bar-baz', 'foo'] WHEN 8 THEN ['top-level'] ELSE [] END AS via FROM f),
r AS (SELECT entity, coalesce(bool_or(direct AND path NOT LIKE '%/%'), FALSE) AS settled FROM x GROUP BY entity),
y AS (SELECT x.*, r.settled FROM x JOIN r USING (entity) WHERE path NOT LIKE '%/%' OR NOT settled),
g AS (SELECT entity, bool_or(direct) AS d, bool_or(named) AS nm, bool_or(NOT whole) AS u, count(*) AS n_files, count(*) FILTER (NOT whole) AS n_unread, list_sort(coalesce(list(path) FILTER (direct), [])) AS declared_in,
  list_sort(coalesce(list(path) FILTER (named AND NOT direct), [])) AS locked_in, list_sort(list_distinct(flatten(coalesce(list(via) FILTER (named AND NOT direct), [])))) AS via,
  CASE WHEN bool_or(direct AND scope = 'required') THEN 'required' WHEN bool_or(direct AND scope = 'optional') THEN 'optional' WHEN bool_or(direct) THEN 'dev' END AS scope, coalesce(bool_and(dump) FILTER (direct), FALSE) AS dumped,
  max({'e': entries, 'p': pinned}) FILTER (direct AND entries IS NOT NULL) AS lg, arg_min(spec, (dump, len(string_split(path, '/')), path)) FILTER (direct AND spec IS NOT NULL) AS spec FROM y GROUP BY entity)
SELECT r.entity, CASE WHEN d THEN 'declared' WHEN nm THEN 'lock only' WHEN u THEN 'unread' ELSE 'not found' END AS status, CASE WHEN settled THEN 'root' ELSE 'all' END AS searched,
  coalesce(array_to_string(declared_in, ','), '') AS declared_in, coalesce(array_to_string(locked_in, ','), '') AS locked_in, coalesce(array_to_string(via, ','), '') AS via, scope, coalesce(dumped, FALSE) AS dumped,
  lg.e AS longest, lg.p AS pinned, spec, coalesce(n_files, 0) AS n_files, coalesce(n_unread, 0) AS n_unread FROM r LEFT JOIN g USING (entity)""")
def declarations(spark: SparkSession, sf: str) -> DataFrame:
    """Each kind of part of a brand is an entity, its sizes are its files; some files of the last kind couldn't be read."""
    parts = table(spark, sf, "part").select(F.concat_ws(" ", "p_brand", "p_type").alias("entity"), "p_size").distinct()
    size, shape = F.col("p_size").cast("string"), (F.col("p_size") % len(FILES)).cast("int")
    pick = lambda i: F.replace(F.get(F.array(*[F.lit(f[i]) for f in FILES]), shape), F.lit("{s}"), size)
    files = parts.select("entity", pick(0).alias("path"), F.when(F.col("p_size") % 40 != 19, pick(1)).alias("text"))
    found = deps.declarations(files, "entity", "quarry-mill", ["quarry-core"], "quarry/mill")
    joined = [F.array_join(c, ",").alias(c) for c in ("declared_in", "locked_in", "via")]
    return found.select("entity", "status", "searched", *joined, "scope", "dumped", "longest", "pinned", "spec", "n_files", "n_unread")


# Brackets four deep and inside strings, one call inside another, one that never closes.
CALLS = """fit(a=g(h(k(#))), b="),(", c=[1, (2, 3)], *rest, **kw)
!run(#, '")', d = { "x": fit(#) }, e=1.5, e=2) fit(open"""


@query("""
SELECT p_partkey, v.position::INT AS position, v.name, replace(v.arguments, '#', p_size::VARCHAR) AS arguments, v.n_args::INT AS n_args, v.star, v.literals FROM part, (VALUES
  (0, 'fit', 'a=g(h(k(#))), b="),(", c=[1, (2, 3)], *rest, **kw', 1, TRUE, 'b="),("'), (1, 'run', '#, ''")'', d = { "x": fit(#) }, e=1.5, e=2', 2, FALSE, 'e=2'), (2, 'fit', '#', 1, FALSE, '')) v(position, name, arguments, n_args, star, literals)""")
def bracket_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Calls in text that doesn't parse."""
    parts = spread(table(spark, sf, "part").select("p_partkey", "p_size")).select("p_partkey", F.replace(F.lit(CALLS), F.lit("#"), F.col("p_size").cast("string")).alias("text"))
    calls = code.balanced_calls(parts, "p_partkey", "text", "fit|run")
    literals = F.array_join(F.transform(F.map_entries("literals"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return calls.select("p_partkey", "position", "name", "arguments", "n_args", "star", literals.alias("literals"))


@query("""
SELECT event_id, '$.a.b[1].c.d.e[0].user' AS path, user_id::VARCHAR AS value FROM events UNION ALL SELECT event_id, '$.a.b[0]', event_type FROM events UNION ALL SELECT event_id, '$.flag', 'true' FROM events""")
def deep_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Leaves eight levels down."""
    text = F.concat(F.lit('{"a": {"b": ["'), "event_type", F.lit('", {"c": {"d": {"e": [{"user": '), F.col("user_id").cast("string"), F.lit('}]}}}]}, "flag": true, "none": {}}'))
    return deps.key_paths(table(spark, sf, "events").select("event_id", text.alias("t")), "event_id", "t")
