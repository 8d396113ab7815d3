"""Filters, joins, set operations, orders and windows as generic transforms: fn(df, ...) -> DataFrame, no actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import numbered, running


def first_failed(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that a row breaks (a null condition counts as broken); null if none."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])


def funnel(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """step, reason, before, after, dropped of each rule in order, in one pass over df."""
    names = [n for n, _ in rules]
    failed = df.groupBy(first_failed(rules).alias("reason")).agg(F.count("*").alias("n"))
    one = failed.agg(*[F.coalesce(F.sum(F.when(F.col("reason") == n, F.col("n"))), F.lit(0)).alias(f"d{i}") for i, n in enumerate(names)], F.coalesce(F.sum("n"), F.lit(0)).alias("all"))
    steps, before = [], F.col("all")
    for i, n in enumerate(names):
        after = before - F.col(f"d{i}")
        steps.append(F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("reason"), before.alias("before"), after.alias("after"), F.col(f"d{i}").alias("dropped")))
        before = after
    return one.select(F.explode(F.array(*steps)).alias("s")).select("s.*")


def keep_reason(df: DataFrame, reasons: list[tuple[str, Column]], out: str = "reason") -> DataFrame:
    """Adds the first reason that holds, null if none does."""
    return df.withColumn(out, F.coalesce(*[F.when(F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in reasons]))


def category(rules: list[tuple[str, Column]], default: str) -> Column:
    """The first category whose condition holds."""
    return F.coalesce(*[F.when(ok, F.lit(name)) for name, ok in rules], F.lit(default))


def recode(c: Column, table: dict[str, str], strict: bool = True) -> Column:
    """Lookup by a literal map; strict raises on a value the table lacks."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(pairs, c)
    return F.when(found.isNull() & c.isNotNull(), F.raise_error(F.concat(F.lit("no code for "), c)).cast("string")).otherwise(found) if strict else found


def align_union(*frames: DataFrame, columns: list[str]) -> DataFrame:
    """Union of frames with different columns in a fixed column order; missing ones are null."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out.select(*columns)


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest hash of the key: fair, and the same on every run."""
    return df.withColumn("h", F.sha2(F.col(key).cast("string"), 256)).orderBy("h", key).limit(n)


def join_1to1(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that fails the job if the right side repeats a key (so no left row multiplies)."""
    once = right.groupBy(key).agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in right.columns if c != key])
    joined = left.join(once, key, "left")
    check = F.when(F.col("__n") > 1, F.raise_error(F.lit(f"{key} is repeated"))).otherwise(F.lit(True))
    return joined.where(check.cast("boolean")).drop("__n")


def membership(df: DataFrame, key: Column, members: DataFrame, member_key: str, out: str) -> DataFrame:
    """Adds whether the case-folded key is among the members; null keys are not."""
    keys = members.select(F.lower(F.col(member_key).cast("string")).alias("__k")).where("__k is not null").distinct().withColumn("__in", F.lit(True))
    return df.withColumn("__k", F.lower(key.cast("string"))).join(keys, "__k", "left").withColumn(out, F.coalesce("__in", F.lit(False))).drop("__k", "__in")


def not_represented(df: DataFrame, others: DataFrame, on) -> DataFrame:
    """Rows of df without a partner; null keys stay."""
    return df.join(others, on, "left_anti")


def neighbourhood(hits: DataFrame, rows: DataFrame, group: str, at: str, before: int, after: int) -> DataFrame:
    """Rows within [at - before, at + after] of a hit of their group; an equi-join on the expanded places."""
    places = hits.select(group, F.explode(F.sequence(F.col(at) - before, F.col(at) + after)).alias(at)).distinct()
    return rows.join(places, [group, at], "left_semi")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order; all columns; max_by combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return best.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under a total order that names where nulls go."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def at_most(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def group_size(df: DataFrame, keys: list[str], out: str, minus: int = 0) -> DataFrame:
    """Adds the size of each row's group, by an aggregate joined back (no window over a hot key)."""
    sizes = df.groupBy(*keys).agg((F.count("*") - minus).alias(out))
    cond = [df[k].eqNullSafe(sizes[k]) for k in keys]
    return df.join(sizes, cond).drop(*[sizes[k] for k in keys])


def islands(df: DataFrame, group: str, at: str) -> DataFrame:
    """Adds gap: whether a row doesn't follow its group's row before; the first row has none."""
    before = F.lag(at).over(Window.partitionBy(group).orderBy(at))
    return df.withColumn("gap", F.coalesce(F.col(at) - before > 1, F.lit(False)))


def running_position(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds position (from 0) over all pages of a group's log, however many rows a group has."""
    return numbered(rows, [group], order, "position", first=0)


def round_robin(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Adds turn: the first of each group have 1, the second 2; sort by (turn, group) to interleave. Groups may be hot."""
    return numbered(df, [group], order, "turn")


def pack_cumsum(df: DataFrame, shard: str, order: list[Column], weight: str, limit: int) -> DataFrame:
    """Adds batch by running weight: each batch holds at most limit plus one item's weight. Shards may be hot."""
    summed = running(df, [shard], order, {"__weight": F.coalesce(F.col(weight), F.lit(0))})
    return summed.withColumn("batch", F.floor((F.col("__weight") - 1) / limit)).drop("__weight")


def precedence_union(frames: list[DataFrame], key: Column, order: list[Column]) -> DataFrame:
    """Rows of the first frame that has a key win; within a frame the last by order wins."""
    tagged = [f.withColumn("__p", F.lit(i)) for i, f in enumerate(frames)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    w = Window.partitionBy("__k").orderBy("__p", *[c.desc_nulls_last() for c in order])
    return out.withColumn("__k", key).withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__p", "__k", "__r")


def expect(df: DataFrame, unique: list[str] = (), not_null: list[str] = (), minimum: dict[str, float] | None = None) -> DataFrame:
    """One row: how many rows break each expectation."""
    checks = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    checks += [F.count_if(F.col(c) < v).alias(f"small_{c}") for c, v in (minimum or {}).items()]
    checks += [(F.count(c) - F.count_distinct(c)).alias(f"repeated_{c}") for c in unique]
    return df.agg(F.count("*").alias("n_rows"), *checks)


def same_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: only_left, only_right and same, whether two tables hold the same set of keys; null is a key like others."""
    sides = left.select(F.struct(F.col(key)).alias("k"), F.lit(1).alias("side")).unionByName(right.select(F.struct(F.col(key)).alias("k"), F.lit(2).alias("side")))
    each = sides.groupBy("k").agg(F.bit_or("side").alias("sides"))
    n = each.agg(F.count_if(F.col("sides") == 1).alias("only_left"), F.count_if(F.col("sides") == 2).alias("only_right"))
    return n.withColumn("same", (F.col("only_left") == 0) & (F.col("only_right") == 0))
