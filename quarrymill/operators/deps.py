"""Dependency facts: line facts, manifests and locks by key path, the declaration table, who requires a package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.logs import write_verified
from .rollup import classify_files

# Fixed file names: locks and manifests of packaging tools, and the lock that is JSON.
TOML_LOCKS, TOML_MANIFESTS, JSON_LOCKS = ("uv.lock", "poetry.lock", "pdm.lock"), ("pyproject.toml", "pipfile", "pixi.toml"), ("pipfile.lock",)
LOCK_WORDS = "lock|freeze|frozen|constraint"
#: Facts of a file that names the package.
FACTS = ["direct", "scope", "specs", "entries", "pinned", "dump", "via"]


def base_name(path: Column) -> Column:
    return F.lower(F.element_at(F.split(path, "/"), -1))


def line_facts(files: DataFrame, package: str, own: list[str], repo: str | None = None, text: str = "text") -> DataFrame:
    """Adds named and FACTS, as far as lines tell. direct is unknown (null) in a lock without notes on who requires the package.

    A comment that names the package doesn't count. Listings compiled by a tool are read like locks. A listing that names
    the package's own dependencies is a dump; setup files are no listings.
    """
    name = T.name_regex(package, repo)
    base = base_name(F.col("path"))
    rows = files.withColumn("__lines", F.split(text, r"\R")).withColumn("__bare", F.transform("__lines", T.strip_comment))
    rows = rows.withColumn("__hits", F.filter(F.sequence(F.lit(0), F.size("__bare") - 1), lambda i: F.get("__bare", i).rlike(name)))
    setup, yaml = base.startswith("setup."), base.rlike(r"\.ya?ml$")
    told = F.array_join(F.transform("__hits", lambda i: F.get("__bare", i)), "\n")
    section = T.last_section(F.col("__lines"), F.get("__hits", F.lit(0)))
    by_section = F.when(section == "extras_require", "optional").when(section.isin("tests_require", "setup_requires"), "dev").otherwise("required")
    compiled = ~setup & (F.lower(F.substring(text, 1, 600)).contains("autogenerated by") | base.rlike(LOCK_WORDS) | base.isin(*TOML_LOCKS, *JSON_LOCKS))
    notes = F.when(compiled, F.flatten(F.transform("__hits", lambda i: T.via_notes(F.col("__lines"), i)))).otherwise(F.array().cast("array<string>"))
    rows = rows.select(*files.columns, F.coalesce(F.size("__hits") > 0, F.lit(False)).alias("named"), *[c.alias(f"__{n}") for n, c in {
        "compiled": compiled, "notes": notes, "scope": F.when(setup, by_section).otherwise(T.file_scope(F.col("path"))), "specs": T.specifiers(told, package, repo),
        "listing": F.when(~setup, T.listing_facts(F.col("__lines"), yaml, own))}.items()])
    by_itself = F.exists("__notes", lambda v: v.rlike(r"^-r\b|\.(?:in|txt)\b|pyproject\.toml|setup\.(?:py|cfg)"))
    direct = F.when(~F.col("__compiled") | by_itself, True).when(F.size("__notes") > 0, False)
    structured = base.isin(*TOML_LOCKS, *JSON_LOCKS)  # read as lines only where it is broken
    via = F.when(direct, F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.transform("__notes", lambda v: T.normalize_name(F.get(F.split(v, r"\s+"), F.lit(0)))))))
    facts = {"direct": F.when(~structured, direct), "scope": F.col("__scope"), "specs": F.col("__specs"), "entries": F.col("__listing.entries"), "pinned": F.col("__listing.pinned"), "dump": F.coalesce("__listing.names_own", F.lit(False)), "via": via}
    return rows.select(*files.columns, "named", *[F.when(F.col("named"), c).alias(n) for n, c in facts.items()])


def toml_json(files: DataFrame, key: str, text: str) -> DataFrame:
    """key, json of TOML texts; null where one is broken. Read in Arrow batches, a text at a time."""

    def read(batches):
        import json
        import tomllib

        import pandas as pd

        def one(t):
            try:
                return json.dumps(tomllib.loads(t), default=str)
            except (tomllib.TOMLDecodeError, TypeError, RecursionError):
                return None

        for b in batches:
            yield pd.DataFrame({key: b[key], "json": [one(t) for t in b[text]]}, columns=[key, "json"])

    return files.select(key, text).mapInPandas(read, f"`{key}` {dict(files.dtypes)[key]}, json string")


def json_nodes(docs: DataFrame, key: str, json: str) -> DataFrame:
    """key, path, keys, name, v, inner for every node of a JSON text, at any depth; text that isn't JSON has no rows.

    path is written like $.a[0]; keys are the objects' keys above the node, name its own key (null in a list), v the node
    as a variant. Each level is a table of its own in the shared folder, which only holds what goes deeper.
    """
    level = docs.select(F.col(key).alias("__key"), F.lit("$").alias("path"), F.array().cast("array<string>").alias("above"), F.try_parse_json(json).alias("v")).where("v is not null")
    out = None
    while True:
        opened = level.alias("l").lateralJoin(_opened(level.sparkSession))
        name, inner = F.col("key"), F.schema_of_variant("value").rlike("^(OBJECT|ARRAY)")
        nodes = opened.select("__key", F.concat("path", F.coalesce(F.concat(F.lit("."), "key"), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))).alias("path"),
                              F.col("above").alias("keys"), name.alias("name"), F.when(name.isNotNull(), F.concat("above", F.array(name))).otherwise(F.col("above")).alias("above"), F.col("value").alias("v"), inner.alias("inner"))
        nodes = write_verified(nodes, "nodes")
        out = nodes if out is None else out.unionByName(nodes)
        level = nodes.where("inner").select("__key", "path", "above", "v")
        if not level.limit(1).count():
            return out.select(F.col("__key").alias(key), "path", "keys", "name", "v", "inner")


def _opened(spark) -> DataFrame:
    return spark.tvf.variant_explode(F.col("l.v").outer())


def key_paths(docs: DataFrame, key: str, json: str) -> DataFrame:
    """key, path, value of every leaf of a JSON text, at any depth."""
    return json_nodes(docs, key, json).where("not inner").select(key, "path", F.expr("try_variant_get(v, '$', 'string')").alias("value"))


def manifest_facts(nodes: DataFrame, key: str, package: str, repo: str | None = None) -> DataFrame:
    """key, scope (the strongest), specs, places of the package in manifests, whose nodes json_nodes gives.

    It is declared by a key of its name in a table of dependencies, or by a requirement text in such a table or list.
    """
    text = F.expr("try_variant_get(v, '$', 'string')")
    of = lambda field: F.expr(f"try_variant_get(v, '$.{field}', 'string')")
    obj = F.schema_of_variant("v").startswith("OBJECT")
    keyed = nodes.where((T.normalize_name(F.col("name")) == T.normalize_name(F.lit(package)))).withColumn("place", F.array_join("keys", "."))
    located = obj & (of("git").isNotNull() | of("path").isNotNull() | of("url").isNotNull() | of("file").isNotNull())
    spec = F.when(~F.col("inner") | obj, T.table_specifier(F.when(obj, of("version")).otherwise(text), located))
    scope = T.key_path_scope(F.col("place"))
    optional = obj & F.coalesce(of("optional") == "true", F.lit(False))
    keyed = keyed.where(scope.isNotNull()).select(key, "place", F.when(optional, "optional").otherwise(scope).alias("scope"), F.when(spec.isNotNull(), F.array(spec)).otherwise(F.array().cast("array<string>")).alias("specs"))
    place = F.array_join(F.when(F.col("name").isNull(), F.col("keys")).otherwise(F.concat("keys", F.array("name"))), ".")
    written = nodes.where(F.schema_of_variant("v") == "STRING").withColumn("place", place).withColumn("text", text).where(F.col("text").rlike(T.name_regex(package, repo)) & scope.isNotNull())
    written = written.select(key, "place", scope.alias("scope"), T.specifiers(F.col("text"), package, repo).alias("specs"))
    rank = F.array_position(F.array(F.lit("required"), F.lit("optional"), F.lit("dev")), F.col("scope"))
    both = keyed.unionByName(written).select("*", F.explode_outer("specs").alias("spec"))
    return both.groupBy(key).agg(F.min_by("scope", rank).alias("scope"), F.array_sort(F.collect_set("spec")).alias("specs"), F.array_sort(F.collect_set("place")).alias("places"))


def lock_packages(docs: DataFrame, key: str, json: str) -> DataFrame:
    """key, name, deps, own of each package that a lock (as JSON) lists, in any of the three known layouts.

    Dependencies are objects with a name, requirement texts, or a table keyed by name; groups of them count as well. own:
    the project itself or one of its members.
    """
    schema = "struct<package:array<string>>"
    rows = docs.select(key, F.explode(F.from_json(json, schema)["package"]).alias("p"))
    v = rows.select(key, F.try_parse_json("p").alias("p"))
    names = "array<struct<name:string>>"
    listed = lambda c: F.transform(F.coalesce(F.from_json(c, names), F.array().cast(names)), lambda x: x["name"])
    texts = lambda c: F.transform(F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>")), lambda x: T.head_name(x))
    get = lambda c: F.expr(f"try_variant_get(p, '${c}', 'string')")
    deps = get(".dependencies")
    found = F.when(deps.startswith("{"), F.json_object_keys(deps)).otherwise(F.concat(listed(deps), texts(deps)))
    groups = [F.flatten(F.transform(F.map_values(F.from_json(get(f'["{g}"]'), "map<string,string>")), lambda x: F.concat(listed(x), texts(x)))) for g in ("optional-dependencies", "dev-dependencies")]
    every = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in (found, *groups)])
    own = F.coalesce(F.exists(F.json_object_keys(get(".source")), lambda k: k.isin("editable", "virtual", "directory")), F.lit(False))
    return v.select(key, T.normalize_name(F.coalesce(get(".name"), F.lit(""))).alias("name"), F.array_distinct(F.transform(F.filter(every, lambda x: x.isNotNull() & (x != "") & ~x.startswith("{")), T.normalize_name)).alias("deps"), own.alias("own"))


def file_facts(files: DataFrame, package: str, own: list[str], repo: str | None = None) -> DataFrame:
    """files (with path, text) and named, whole, FACTS: what each dependency file says of a package.

    Only files that hold the name are read further: manifests and locks by their structure, the rest, and broken ones, by
    their lines. Structured facts are joined back by a file's number.
    """
    name, base = T.name_regex(package, repo), base_name(F.col("path"))
    marked = write_verified(files.withColumn("__file", F.sha2(F.concat_ws("\0", "path", "text"), 256)).withColumn("__held", F.coalesce(F.col("text").rlike(name), F.lit(False))), "files")
    structured = marked.where(F.col("__held") & base.isin(*TOML_LOCKS, *TOML_MANIFESTS, *JSON_LOCKS)).select("__file", "text", base.alias("base")).dropDuplicates(["__file"])
    parsed = toml_json(structured.where(~F.col("base").isin(*JSON_LOCKS)), "__file", "text").unionByName(structured.where(F.col("base").isin(*JSON_LOCKS)).select("__file", F.when(F.try_parse_json("text").isNotNull(), F.col("text")).alias("json")))
    parsed = write_verified(structured.select("__file", "base").join(parsed.where("json is not null"), "__file"), "parsed")
    none = F.array().cast("array<string>")
    fact = lambda df, direct, scope=None, specs=none, via=none: df.select("__file", F.lit(True).alias("s_named"), direct.alias("s_direct"), (F.lit(None).cast("string") if scope is None else scope).alias("s_scope"), specs.alias("s_specs"), via.alias("s_via"))
    nodes = json_nodes(parsed.where(F.col("base").isin(*TOML_MANIFESTS)), "__file", "json")
    manifests = fact(manifest_facts(nodes, "__file", package, repo), F.lit(True), F.col("scope"), F.col("specs"))
    target = T.normalize_name(F.lit(package))
    locks = requirers(lock_packages(parsed.where(F.col("base").isin(*TOML_LOCKS)), "__file", "json"), "__file", "name", "deps", target, "own")
    locks = fact(locks, F.col("direct"), via=F.col("via"))
    pinned = F.array_union(F.coalesce(F.json_object_keys(F.get_json_object("json", "$.default")), none), F.coalesce(F.json_object_keys(F.get_json_object("json", "$.develop")), none))
    plain = parsed.where(F.col("base").isin(*JSON_LOCKS) & F.exists(pinned, lambda k: T.normalize_name(k) == target))
    plain = fact(plain, F.lit(None).cast("boolean"))
    told = parsed.select("__file", F.lit(True).alias("read")).join(manifests.unionByName(locks).unionByName(plain), "__file", "left")
    lines = line_facts(marked.join(told, "__file", "left"), package, own, repo)
    by = lambda c, s: F.when(F.col("read"), s).otherwise(F.col(c))  # noqa: E731  the structure decides where it could be read
    named = F.col("__held") & F.coalesce(by("named", F.coalesce("s_named", F.lit(False))), F.lit(False))
    nothing = {"entries": "int", "pinned": "int", "dump": "boolean"}
    values = {c: by(c, F.lit(None).cast(nothing[c]) if c in nothing else F.col(f"s_{c}")) for c in FACTS}
    return lines.select(*files.columns, named.alias("named"), F.col("text").isNotNull().alias("whole"), *[F.when(named, v).alias(c) for c, v in values.items()])


def declarations(files: DataFrame, entity: str, package: str, own: list[str], repo: str | None = None) -> DataFrame:
    """One row for each entity: what its dependency files say of a package.

    Files at the root come first; only entities that they don't settle (no declaration) have the rest of their files read.
    status, searched (root or all), declared_in, locked_in, via, scope, dumped (declared by dumps alone), longest and pinned (of
    the longest declaring listing), spec with its kind and anchor, n_files, n_unread (without text).
    """
    root = files.where(~F.contains("path", F.lit("/")))
    facts = write_verified(file_facts(root, package, own, repo), "root")
    settled = facts.where("named and direct").select(entity).distinct()
    rest = files.where(F.contains("path", F.lit("/"))).join(settled, entity, "left_anti")
    deep = file_facts(rest, package, own, repo)
    known = classify_files(facts.unionByName(deep).withColumn("spec", T.most_specific(F.col("specs"))), entity)
    every = files.select(entity).distinct().join(known, entity, "left").join(settled.withColumn("__settled", F.lit(True)), entity, "left")
    none = F.array().cast("array<string>")
    lists = [F.coalesce(c, none).alias(c) for c in ("declared_in", "locked_in", "via")]
    kind = T.version_kind(F.col("spec"))
    return every.select(
        entity, F.coalesce("status", F.lit("not found")).alias("status"), F.when(F.col("__settled"), "root").otherwise("all").alias("searched"), *lists, "scope", F.coalesce("dumped", F.lit(False)).alias("dumped"),
        "longest", "pinned", "spec", F.when(F.col("spec").isNotNull(), kind["kind"]).alias("kind"), F.when(F.col("spec").isNotNull(), kind["anchor"]).alias("anchor"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_files", "n_unread")],
    )


def listed_requirement(packages: DataFrame, key: str, requirements: str, package: str, repo: str | None = None) -> DataFrame:
    """The same of entities known by their metadata only, an array of requirement texts: key, status, scope, spec, kind, anchor."""
    scope = T.dependency_kind(F.col(requirements), package)
    spec = T.most_specific(T.specifiers(F.array_join(requirements, "\n"), package, repo), ("",))
    rows = packages.select(key, F.when(scope != "absent", scope).alias("scope"), F.when(scope != "absent", spec).alias("spec"))
    kind = T.version_kind(F.col("spec"))
    return rows.select(key, F.when(F.col("scope").isNull(), "not found").otherwise("declared").alias("status"), "scope", "spec", F.when(F.col("spec").isNotNull(), kind["kind"]).alias("kind"), F.when(F.col("spec").isNotNull(), kind["anchor"]).alias("anchor"))


def requirers(packages: DataFrame, file: str, name: str, deps: str, target: str | Column, own: str) -> DataFrame:
    """file, direct, via: who requires the target in a lock file; the project itself or nobody means direct."""
    edges = packages.select(file, F.col(name).alias("by"), F.explode(deps).alias("dep"), F.col(own).alias("own"))
    hits = edges.where(F.col("dep") == target).groupBy(file).agg(F.bool_or("own").alias("o"), F.array_sort(F.collect_set(F.when(~F.col("own"), F.col("by")))).alias("via"))
    present = packages.where(F.col(name) == target).select(file).distinct()
    rows = present.join(hits, file, "left")
    direct = F.coalesce("o", F.lit(True)) | (F.size("via") == 0)
    return rows.select(file, direct.alias("direct"), F.when(direct, F.array().cast("array<string>")).otherwise(F.col("via")).alias("via"))
