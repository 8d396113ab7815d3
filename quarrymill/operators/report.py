"""The final table's answers: labels of values, costs, details of a card, and the join that must stay one row per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import call_text, nonblank
from .relational import join_1to1

# Fixed labels of answers that aren't a value.
NO_CALL, SEVERAL, UNREADABLE, OTHER = "No call to read", "Several values", "Not readable", "Other"


def value_labels(answers: DataFrame, entity: str, default: str | None, least: int) -> DataFrame:
    """entity, label from (entity, answer, value) as value_given gives them; a null answer is an entity without calls.

    A value that fewer than least entities give is "Other"; the default that somebody wrote is told apart from the one that
    was left out. The default is a token, null if it isn't known.
    """
    left_out = F.lit("Default") if default is None else F.lit(f"Default ({default})")
    counts = answers.where("answer = 'VALUE'").groupBy("value").agg(F.count("*").alias("__n"))
    written = F.col("value").eqNullSafe(F.lit(default))
    label = (
        F.when(F.col("answer").isNull(), NO_CALL).when(F.col("answer") == "SEVERAL", SEVERAL).when(F.col("answer") == "DEFAULT", left_out).when(F.col("answer") == "UNREADABLE", UNREADABLE)
        .when(F.col("__n") < least, OTHER).when(written, F.concat("value", F.lit(", written out"))).otherwise(F.col("value"))
    )
    return answers.join(counts, "value", "left").select(entity, label.alias("label"))


def class_defaults(signatures: DataFrame, calls: DataFrame) -> DataFrame:
    """parameter, preset of the class that is built most (ties by name); signatures as code.read_signatures gives them."""
    built = calls.where(F.col("method").isNull()).groupBy(F.substring_index("name", ".", -1).alias("class")).agg(F.count("*").alias("n"))
    most = built.agg(F.max_by("class", F.struct("n", "class")).alias("class"))  # one row
    return signatures.join(F.broadcast(most), "class").where(F.col("preset").isNotNull() & (F.col("preset") != "<expr>")).select("parameter", "preset")


def cost_report(calls: DataFrame, prices: dict[str, tuple[float, float]], left: DataFrame, batch: bool = True, write: float = 1.25, read: float = 0.1) -> DataFrame:
    """One row for each model: what its calls cost and what those still to do would, as a batch (half the price).

    calls: model, input_tokens, cache_written, cache_read, output_tokens (null: none). prices: a million tokens read and
    written out. left: model, n_left. write and read are what caching a token and finding it costs, as shares of reading it.
    hit_rate is the share of cached requests that found the cache; left_cached supposes it stays so, left_plain no caching.
    """
    price = lambda i: F.create_map(*[F.lit(x) for m, p in prices.items() for x in (m, float(p[i]))])[F.col("model")]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    g = calls.groupBy("model").agg(
        F.count("*").alias("calls"), total("input_tokens").alias("plain"), total("cache_written").alias("stored"), total("cache_read").alias("found"), total("output_tokens").alias("answers"),
        F.count_if(F.col("cache_read") > 0).alias("hits"), F.count_if(F.col("cache_written") > 0).alias("writes"),
    )
    g = g.join(left, "model", "left").withColumn("n_left", F.coalesce("n_left", F.lit(0)))
    unit = 2e6 if batch else 1e6
    cost = (F.col("plain") * price(0) + F.col("stored") * price(0) * write + F.col("found") * price(0) * read + F.col("answers") * price(1)) / unit
    scale = F.col("n_left") / F.col("calls") / 2e6
    shared, rest, said = (F.col("stored") + F.col("found")) * price(0) * scale, F.col("plain") * price(0) * scale, F.col("answers") * price(1) * scale
    rate = F.col("hits") / F.nullif(F.col("hits") + F.col("writes"), F.lit(0))
    return g.select(
        "model", "calls", (F.col("plain") + F.col("stored") + F.col("found")).alias("input_tokens"), F.col("answers").alias("output_tokens"), F.round(cost, 6).alias("cost"), F.round(rate, 6).alias("hit_rate"),
        F.round(shared * (rate * read + (1 - rate) * write) + rest + said, 6).alias("left_cached"), F.round(shared + rest + said, 6).alias("left_plain"),
    )


def declaration_detail(category: Column, listed: Column, locked: Column, via: Column, declared_in: Column, scope: Column, spec: Column, metadata: Column) -> Column:
    """A declaration's category with what a card has room for: what pulled the package in, or the file, the scope and the versions.

    listed and locked say which categories those are. The file is the shallowest that names the package, lists before locks.
    """
    more = F.size(via) - 2
    pulled = F.concat(category, F.lit(", via "), F.array_join(F.slice(via, 1, 2), ", "), F.when(more > 0, F.concat(F.lit(" +"), more.cast("string"))).otherwise(""))
    ranked = F.array_min(F.transform(declared_in, lambda p: F.struct(p.endswith(".lock").alias("lock"), F.size(F.split(p, "/")).alias("depth"), p.alias("path"))))["path"]
    where = F.when(metadata, "package metadata").otherwise(F.coalesce(F.substring_index(ranked, "/", -1), F.lit("?")))
    scoped = F.when(scope == "optional", ", optional").when(scope == "dev", ", development").otherwise("")
    asked = F.when(spec.isNull(), "").when(spec == "", ", any version").when(spec == "from source", ", from source").otherwise(F.concat(F.lit(" "), spec))
    return F.when(locked & (F.size(via) > 0), pulled).when(listed, F.concat(category, F.lit(" ("), where, scoped, F.lit(")"), asked)).otherwise(category)


def version_category(kind: Column, listed: Column, dumped: Column) -> Column:
    """Which versions an entity asks for; nobody chose those of a dumped environment."""
    return F.when(dumped, "Environment dump").when(~listed, "Not in a dependency list").when(kind.isNull() | (kind == "From source"), "Other").otherwise(kind)


def code_detail(use: Column, category: Column, elsewhere: Column, through: Column, calls: Column, called: Column, features: Column, sentence: Column) -> Column:
    """What an entity's code does, with the names, the commonest call, its features and a sentence, joined by a middle dot.

    calls: array of struct(name, kwargs, star, n), the commonest first. Of other libraries' functions one that computes is
    shown before one that plots (.pl. in its name).
    """
    names = F.when(F.size(elsewhere) > 0, elsewhere).otherwise(through)
    shown = F.array_min(F.transform(names, lambda n: F.struct(n.contains(".pl.").alias("plots"), n.alias("name"))))["name"]
    first = F.get(calls, F.lit(0))
    own = F.when(F.size(calls) > 0, call_text(first["name"], first["kwargs"], first["star"])).when(F.size(called) > 0, F.concat(category, F.lit(" ("), F.get(called, F.lit(0)), F.lit(")"))).otherwise(category)
    others = F.size(calls) - 1
    note = F.when(others > 0, F.concat(F.lit("+"), others.cast("string"), F.lit(" other configuration"), F.when(others > 1, "s").otherwise("")))
    listed = F.when(F.size(features) > 0, F.concat(F.lit("Features: "), F.array_join(features, ", ")))
    return (
        F.when(use == "through another", F.concat(category, F.lit(" ("), shown, F.lit(")"))).when(use == "imports only", F.concat(category, F.lit(" (imported, never called)")))
        .when(use.isin("names only", "mentions"), F.concat(category, F.lit(" (in names, strings or comments)"))).when(use != "calls", category)
        .otherwise(F.concat_ws(" · ", own, note, listed, nonblank(sentence)))
    )


def use_detail(use: Column, shown: Column, purposes: Column, stated: Column, silent: list[str], whole: list[str] = ()) -> Column:
    """Every purpose that the code shows, the one shown first; without calls what the entity itself states, if it isn't silent.

    whole: shown values that stand for several purposes already.
    """
    rest = F.array_join(F.concat(F.array(shown), F.array_remove(purposes, shown)), ", ")
    told = nonblank(stated).isNotNull() & ~F.coalesce(stated, F.lit("")).isin(*silent)
    return F.when((use != "calls") & told, F.concat(stated, F.lit(" (stated)"))).when((use != "calls") | shown.isin(*whole), shown).otherwise(rest)


def data_detail(known: Column, shown: Column, form: Column, detail: Column, other: str, silent: list[str]) -> Column:
    """The kind of data with the form it comes in; for a kind that no label names, the answer's own words."""
    words = F.concat(F.upper(F.substring(F.trim(detail), 1, 1)), F.substring(F.trim(detail), 2, 2**31 - 1))
    return F.when(~known, shown).when((shown == other) & nonblank(detail).isNotNull(), words).when(shown.isin(*silent) | F.coalesce(form, F.lit(silent[0])).isin(*silent), shown).otherwise(F.concat(shown, F.lit(" · "), F.lower(form)))


def answered(entities: DataFrame, key: str, sides: list[tuple[DataFrame, dict[str, object]]]) -> DataFrame:
    """entities with the columns of each side, joined one to one; answers of a side without a row are its defaults.

    A side with repeated keys stops the job, so the table keeps a row for each entity.
    """
    for side, defaults in sides:
        entities = join_1to1(entities, side, key)
        entities = entities.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    return entities
