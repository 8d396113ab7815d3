"""What each project's code does with one module: the facts of its distinct texts, rolled up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.logs import write_verified
from . import code
from .entity import use_class


def labels_found(text: Column, patterns: dict[str, str]) -> Column:
    """The labels whose pattern a text holds, in order."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(label)) for label, p in patterns.items()])) if patterns else F.array().cast("array<string>")


def configurations(calls: DataFrame, entity: str) -> DataFrame:
    """entity, name, kwargs, star, n: distinct constructor calls; the order of arguments doesn't count."""
    made = calls.where(F.col("method").isNull() & F.substring_index("name", ".", -1).rlike(r"^\p{Lu}"))
    form = F.array_sort(F.map_entries("kwargs"))
    return made.groupBy(entity, "name", "star", form.alias("__form")).agg(F.count("*").alias("n")).select(entity, "name", F.map_from_entries("__form").alias("kwargs"), "star", "n")


def argument_values(calls: DataFrame, entity: str) -> DataFrame:
    """entity, arg, written, followed, n_unresolved of the arguments of constructor calls."""
    made = calls.where(F.col("method").isNull() & F.substring_index("name", ".", -1).rlike(r"^\p{Lu}"))
    pairs = made.select(entity, "followed", F.explode("kwargs").alias("arg", "value"))
    known, through = F.col("value") != code.UNREAD, F.array_contains("followed", F.col("arg"))
    distinct = pairs.groupBy(entity, "arg", "value", through.alias("through")).agg(F.count("*").alias("n"))
    values = lambda ok: F.array_sort(F.collect_list(F.when(known & ok, F.col("value"))))
    return distinct.groupBy(entity, "arg").agg(values(~F.col("through")).alias("written"), values(F.col("through")).alias("followed"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("n_unresolved"))


def project_usage(
    files: DataFrame, entity: str, path: str, text: str, module: str, signatures: DataFrame | None = None, known: list[str] | None = None, own: list[str] | None = None,
    signals: dict[str, str] | None = None, carriers: dict[str, tuple[str, str]] | None = None, learn: tuple[tuple[str, ...], str] = (("fit", "fit_transform"), "y"), most_files: int = 10,
) -> DataFrame:
    """One row for each entity with files: counts, flags, sorted sets of names, and how it uses the module.

    signals: label -> pattern, searched in files that name the module. carriers: label -> (module, pattern); a library that
    runs the module for its caller counts where the project imports that library as well. learn: methods that take a
    target as their second argument or under a name. A file without text is unread. Facts are read once for each distinct
    text and written to the shared folder (an action), as many joins use them; sets are built from distinct rows, so a project of any size gathers its distinct names only.
    """
    rows = files.select(F.col(f"`{entity}`").alias("entity"), F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("text")).withColumn("blob", F.sha2("text", 256))
    naming = F.coalesce(F.contains(F.lower("text"), F.lit(module.lower())), F.lit(False))
    carried = {label: p for label, (_, p) in (carriers or {}).items()}
    seen = rows.select(
        "entity", "path", "blob", naming.alias("naming"), F.col("text").isNull().alias("unread"), T.imported_modules(F.col("text")).alias("modules"),
        F.when(naming, labels_found(F.col("text"), signals or {})).alias("signals"), labels_found(F.col("text"), carried).alias("carried"),
    )
    facts = write_verified(code.code_facts(rows, "text", module), "facts")
    at = seen.where("naming").select("entity", "path", "blob")
    calls = code.resolved_calls(facts, module, signatures=signatures, known=known, own=own).withColumn("name", T.canonical_class(F.col("name")))
    calls = write_verified(calls, "calls")
    placed = at.join(calls.hint("merge"), "blob")
    names = code.resolved_names(facts, module, known, own)

    one = lambda rows_, kind, value: rows_.select("entity", F.lit(kind).alias("kind"), value.alias("value"))
    parts = rows.select("entity", F.explode(F.split(F.regexp_replace("path", r"\.py(/|$)", "$1"), "/")).alias("top")).distinct()
    told = at.select("entity", "blob").distinct().join(names.hint("merge"), "blob")
    other = told.where("kind = 'elsewhere'").withColumn("top", F.substring_index("name", ".", 1)).join(parts, ["entity", "top"], "left_anti")
    method, uncertain = F.col("method").isNotNull(), F.col("uncertain")
    values = [
        one(told.where("kind = 'name'"), "names", T.canonical_class(F.col("name"))), one(told.where("kind = 'attribute'"), "attributes", F.substring_index("name", ".", -1)),
        one(told.where("kind = 'form'"), "import_forms", F.col("name")), one(other, "elsewhere", F.col("name")),
        one(placed.where(~method), "called", F.col("name")), one(placed.where(method & ~uncertain), "methods", F.col("method")), one(placed.where(method & uncertain), "unsure", F.col("method")),
        one(placed, "calling_files", F.col("path")),
        *[one(seen.select("entity", F.explode(c).alias("v")), c, F.col("v")) for c in ("modules", "signals", "carried")],
    ]
    sets = values[0]
    for more in values[1:]:
        sets = sets.unionByName(more)
    pick = lambda c: F.array_sort(F.collect_list(F.when(F.col("kind") == c, F.col("value")))).alias(c)
    sets = sets.where("value is not null").distinct().groupBy("entity").agg(*[pick(c) for c in ("names", "attributes", "import_forms", "elsewhere", "called", "methods", "unsure", "calling_files", "modules", "signals", "carried")])

    own_import = (F.col("kind") == "form") & (F.col("target") == module)
    flag = lambda ok: F.coalesce(F.bool_or(ok), F.lit(False))
    texts = facts.groupBy("blob").agg(
        flag(own_import).alias("imports"), flag((F.col("kind") == "star") & (F.substring_index("target", ".", 1) == module)).alias("star_import"),
        flag(own_import & F.col("guarded")).alias("guarded"), flag(own_import & F.col("lazy")).alias("lazy"), flag(F.col("kind") == "unparsed").alias("unparsed"),
    )
    counts = seen.join(texts.hint("merge"), "blob", "left").groupBy("entity").agg(
        F.count("*").alias("n_files"), F.count_if("unread").alias("n_files_unread"), F.count_if("naming").alias("n_files_naming"), F.count_if("unparsed").alias("n_files_unparsed"),
        *[flag(F.col(c)).alias(c) for c in ("imports", "star_import", "guarded", "lazy")],
    )
    constructor = ~method & F.substring_index("name", ".", -1).rlike(r"^\p{Lu}")
    learns = method & ~uncertain & F.col("method").isin(*learn[0]) & ((F.col("n_args") >= 2) | F.map_contains_key("kwargs", learn[1]))
    uses = placed.groupBy("entity").agg(F.count_if(constructor).alias("n_constructor_calls"), flag(constructor & F.col("star")).alias("star_kwargs"), flag(learns).alias("learns_target"))
    out = counts.join(sets, "entity", "left").join(uses, "entity", "left")
    none = F.array().cast("array<string>")
    out = out.select("entity", *counts.columns[1:], *[F.coalesce(c, none).alias(c) for c in sets.columns[1:]], F.coalesce("n_constructor_calls", F.lit(0)).alias("n_constructor_calls"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("star_kwargs", "learns_target")])
    through = F.array_compact(F.array(*[F.when(F.array_contains("carried", label) & F.array_contains("modules", m), F.lit(label)) for label, (m, _) in (carriers or {}).items()])) if carriers else none
    out = out.withColumn("through", through).withColumn("uncertain_methods", F.array_except("unsure", "methods")).withColumn("calling_files", F.slice("calling_files", 1, most_files))
    used = use_class(F.concat("called", "methods", "uncertain_methods"), F.when(F.col("imports") | F.col("star_import"), F.array(F.lit(module))), F.concat("elsewhere", "through"), none, F.col("n_files_naming") > 0, F.lit(True))
    return out.select(F.col("entity").alias(entity), used.alias("use"), *[c for c in out.columns if c not in ("entity", "unsure", "carried")])
