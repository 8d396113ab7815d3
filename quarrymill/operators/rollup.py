"""Aggregates that answer one question for each entity: pools, tallies, nested call rollups, rarest labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_list(c: Column) -> Column:
    """Sorted distinct union of an array column over a group."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))  # a set: repeated lists are held once


def strongest(c: Column, order: list[str]) -> Column:
    """The value that stands first in order."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), c)
    return F.min_by(c, F.when(rank > 0, rank))


def first_known(c: Column, order: Column) -> Column:
    """The first value that isn't null, by a total order."""
    return F.min_by(c, F.when(c.isNotNull(), order))


def freq_all(df: DataFrame, c: str, categories: list[str]) -> DataFrame:
    """position, value, n in the given order, zero where a category has no rows."""
    counts = df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n"))
    spark = df.sparkSession
    order = spark.createDataFrame(list(enumerate(categories)), "position int, value string")
    return order.join(counts, "value", "left").select("position", "value", F.coalesce("n", F.lit(0)).alias("n"))


def tally(df: DataFrame, items: Column, k: int) -> DataFrame:
    """item, n: in how many rows an item of the list occurs; the k most frequent, ties by item."""
    return df.select(F.explode(F.array_distinct(items)).alias("item")).groupBy("item").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "item").limit(k)


def canonical_kwargs(kwargs: Column) -> Column:
    """A map as text, whatever the order its arguments were written in."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kwargs))))


def config_rollup(calls: DataFrame, entity: str, kwargs: str, order: list[str]) -> DataFrame:
    """entity, configurations: distinct argument sets with counts, the commonest first, ties by first use."""
    keyed = calls.withColumn("key", canonical_kwargs(F.col(kwargs))).groupBy(entity, "key").agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))
    entry = F.struct((-F.col("n")).alias("neg"), "first", "key", "n")
    return keyed.groupBy(entity).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.concat(e["key"], F.lit(" x"), e["n"].cast("string"))).alias("configurations"))


def arg_summary(calls: DataFrame, entity: str, kwargs: str) -> DataFrame:
    """entity, arg, written (sorted values), n_unresolved of each argument; <expr> is a value nobody could read."""
    pairs = calls.select(entity, F.explode(kwargs).alias("arg", "value"))
    known = F.col("value") != "<expr>"
    return pairs.groupBy(entity, "arg").agg(F.array_sort(F.collect_set(F.when(known, F.col("value")))).alias("written"), F.count_if(~known).alias("n_unresolved"))


def arg_report(summary: DataFrame, k: int) -> DataFrame:
    """arg, passing, written, unread, commonest: over all entities of arg_summary, with the k values that most entities write.

    unread: entities none of whose values could be read. commonest: "value xN", the commonest first, ties by value.
    """
    none = F.size("written") == 0
    # one pass, as the summary may be large: a row without a value for each entity, then a row for each of its values
    rows = summary.select("arg", none.alias("none"), (none & (F.col("n_unresolved") > 0)).alias("unread"), F.explode(F.concat(F.array(F.lit(None).cast("string")), "written")).alias("value"))
    n = rows.groupBy("arg", "value").agg(F.count("*").alias("n"), F.count_if(~F.col("none")).alias("written"), F.count_if("unread").alias("unread"))
    rank = F.row_number().over(Window.partitionBy("arg").orderBy(F.col("value").isNotNull(), F.desc("n"), "value"))  # distinct values of an argument
    whole = F.col("value").isNull()
    top = n.withColumn("r", rank).where(F.col("r") <= k + 1).groupBy("arg").agg(
        *[F.max(F.when(whole, F.col(c))).alias(out) for c, out in (("n", "passing"), ("written", "written"), ("unread", "unread"))],
        F.array_sort(F.collect_list(F.when(~whole, F.struct("r", "value", "n")))).alias("top"),
    )
    told = F.transform("top", lambda t: F.concat(t["value"], F.lit(" x"), t["n"].cast("string")))
    return top.select("arg", "passing", "written", "unread", told.alias("commonest"))


def equals_typed(kwargs: Column, name: str, value: object) -> Column:
    """Whether an argument has a value of this type: True isn't 1, 2 isn't 2.0, and neither is "2"; null if it isn't given."""
    return kwargs[name] == F.lit(repr(value))


def _like(pattern: str):
    return lambda name: name.rlike(pattern)


def _given(name: str, value: object):
    return lambda kwargs: F.coalesce(equals_typed(kwargs, name, value), F.lit(False))


def feature_rules(methods: Column, called: Column, kwargs: Column, learns: Column, rules: list[tuple[str, dict]]) -> list[tuple[str, Column]]:
    """(name, condition) of each rule: any of methods (names), called (a pattern of dotted names), learns (True), argument (name, value).

    kwargs is an array of maps, one for each call. Parts of a rule are alternatives.
    """
    found = []
    for name, rule in rules:
        parts = [F.array_contains(methods, m) for m in rule.get("methods", ())]
        parts += [F.exists(called, _like(rule["called"]))] if "called" in rule else []
        parts += [learns] if rule.get("learns") else []
        parts += [F.exists(kwargs, _given(*rule["argument"]))] if "argument" in rule else []
        condition = F.lit(False)
        for part in parts:
            condition = condition | F.coalesce(part, F.lit(False))
        found.append((name, condition))
    return found


def value_given(calls: DataFrame, entity: str, value: Column, star: Column) -> DataFrame:
    """entity, answer, value: VALUE (one readable value, whatever other calls hide or leave out), SEVERAL, DEFAULT (left out) or UNREADABLE.

    value is null where a call leaves the argument out; a starred call that does so is silent.
    """
    readable = value.isNotNull() & (value != "<expr>")
    g = calls.groupBy(entity).agg(
        F.count_distinct(F.when(readable, value)).alias("n"), F.min(F.when(readable, value)).alias("v"),
        F.bool_or(F.coalesce(value == "<expr>", F.lit(False))).alias("hidden"), F.bool_or(value.isNull() & ~star).alias("left_out"),
    )
    answer = F.when(F.col("n") > 1, "SEVERAL").when(F.col("n") == 1, "VALUE").when(F.col("left_out") & ~F.col("hidden"), "DEFAULT").otherwise("UNREADABLE")
    return g.select(entity, answer.alias("answer"), F.when(answer == "VALUE", F.col("v")).alias("value"))


def how_often(calls: DataFrame, entity: str, value: Column, star: Column) -> DataFrame:
    """entity, given: EVERY, SOME, NEVER or UNREADABLE. null is not given, <expr> is."""
    given = value.isNotNull() & (value != "null")
    g = calls.groupBy(entity).agg(F.count_if(given).alias("y"), F.count_if(~given & ~star).alias("n"))
    return g.select(entity, F.when((F.col("y") > 0) & (F.col("n") == 0), "EVERY").when(F.col("y") > 0, "SOME").when(F.col("n") > 0, "NEVER").otherwise("UNREADABLE").alias("given"))


def features_used(rules: list[tuple[str, Column]]) -> Column:
    """The names of the rules that hold, in rule order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules]))


def rarest(rows: DataFrame, entity: str, labels: str, order: list[str], pairs: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """entity, label: of an entity's labels the one with the fewest entities; ties by order. An exact pair has its own label.

    An entity with no labels, or a null list, has none (null).
    """
    each = rows.select(entity, F.explode(F.array_distinct(labels)).alias("label"))
    counts = each.groupBy("label").agg(F.count("*").alias("n"))
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("label"))
    best = each.join(counts, "label").groupBy(entity).agg(F.min_by("label", F.struct("n", place, "label")).alias("label"))
    if not pairs:
        return rows.select(entity).join(best, entity, "left")
    set_ = F.array_sort(F.array_distinct(labels))
    own = F.coalesce(*[F.when(set_ == F.array(*[F.lit(x) for x in sorted(p)]), F.lit(v)) for p, v in pairs.items()])
    return rows.select(entity, own.alias("own")).join(best, entity, "left").select(entity, F.coalesce("own", "label").alias("label"))


def fold_rare(df: DataFrame, c: str, least: int, out: str = "shown", other: str = "Other") -> DataFrame:
    """Adds the value, or other where fewer than least rows have it."""
    counts = df.groupBy(c).agg(F.count("*").alias("__n"))
    return df.join(counts, c, "left").withColumn(out, F.when(F.col("__n") < least, other).otherwise(F.col(c))).drop("__n")


def hits_after(rows: DataFrame, group: str, order: list[str], key: str, anchor: Column, reach: int, k: int) -> DataFrame:
    """group, anchor, key: the first k rows that aren't anchors within reach places after each anchor."""
    numbered = rows.select("*", F.row_number().over(Window.partitionBy(group).orderBy(*order)).alias("__i"), anchor.alias("__a"))
    places = numbered.where("__a").select(group, F.col(key).alias("anchor"), F.explode(F.sequence(F.col("__i") + 1, F.col("__i") + reach)).alias("__i"))
    near = numbered.where("not __a").select(group, key, "__i").join(places, [group, "__i"])
    rank = F.row_number().over(Window.partitionBy("anchor").orderBy("__i"))
    return near.withColumn("__r", rank).where(F.col("__r") <= k).select(group, "anchor", key)


def classify_files(files: DataFrame, entity: str) -> DataFrame:
    """entity, status, declared_in, locked_in, via, scope, dumped, longest, pinned, spec, n_files, n_unread.

    Rows are (path, named, whole, direct, scope, entries, pinned, spec, dump, via); named: the file names the package;
    whole: it could be read to its end; pinned and via may be left out. A named file with direct true declares, any other named one is a lock, whose via
    says who requires the package. Scope, longest listing and specifier come from declaring files only, the specifier from
    the first that has one: dumps last, then the shallowest, then by path. dumped: all declaring files are dumps. Without a
    named file, one not read whole leaves "unread".
    """
    for c, kind in (("pinned", "int"), ("via", "array<string>")):
        files = files if c in files.columns else files.withColumn(c, F.lit(None).cast(kind))
    named = F.coalesce(F.col("named"), F.lit(False))
    declared = named & F.coalesce(F.col("direct"), F.lit(False))
    dump, whole = F.coalesce(F.col("dump"), F.lit(False)), F.coalesce(F.col("whole"), F.lit(False))
    depth = F.size(F.split("path", "/"))
    place = F.struct(F.col("entries").alias("n"), F.col("pinned").alias("p"))
    g = files.groupBy(entity).agg(
        F.array_sort(F.collect_set(F.when(declared, F.col("path")))).alias("declared_in"),
        F.array_sort(F.collect_set(F.when(named & ~declared, F.col("path")))).alias("locked_in"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(named & ~declared, F.col("via")))))).alias("via"),
        F.bool_or(~whole).alias("unread"), strongest(F.when(declared, F.col("scope")), ["required", "optional", "dev"]).alias("scope"),
        F.max(F.when(declared & F.col("entries").isNotNull(), place)).alias("longest"),
        F.min_by("spec", F.when(declared & F.col("spec").isNotNull(), F.struct(dump.alias("dump"), depth, "path", "spec"))).alias("spec"),
        F.bool_and(F.when(declared, dump)).alias("dumped"), F.count("*").alias("n_files"), F.count_if(~whole).alias("n_unread"),
    )
    status = F.when(F.size("declared_in") > 0, "declared").when(F.size("locked_in") > 0, "lock only").when(F.col("unread"), "unread").otherwise("not found")
    return g.select(entity, status.alias("status"), "declared_in", "locked_in", "via", "scope", F.coalesce("dumped", F.lit(False)).alias("dumped"), F.col("longest.n").alias("longest"), F.col("longest.p").alias("pinned"), "spec", "n_files", "n_unread")
