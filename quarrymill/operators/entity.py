"""Jobs on entities: families, copies, quotes in texts, shared requests, the final table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import squeeze, ustrip


def contained_quotes(texts: DataFrame, key: str, text: str, quotes: DataFrame, quote_key: str, quote: str, least: int = 8, squeeze: bool = True) -> DataFrame:
    """key, quote_key of each quote of least characters or more that a text contains.

    No pair is tried that shares nothing: a quote's inner words stand whole in the text, so three of them are an
    equi-join key; a quote of fewer words joins on its first eight characters. Then containment decides.
    """
    form = _squeezed if squeeze else (lambda c: c)
    q = quotes.select(F.col(quote_key).alias("qk"), form(F.col(quote)).alias("q")).where(F.length("q") >= least)
    q = q.withColumn("w", F.split("q", r"\s+"))
    t = texts.select(F.col(key).alias("tk"), form(F.col(text)).alias("t")).where("t is not null")
    words = t.withColumn("w", F.split("t", r"\s+"))
    runs = F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 2, F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, 3))))
    long_ = words.select("tk", F.explode(F.array_distinct(runs)).alias("h")).join(q.where("size(w) >= 5").select("qk", F.xxhash64(F.slice("w", 2, 3)).alias("h")), "h")
    grams = F.array_distinct(F.regexp_extract_all("t", F.lit("(?s)(?=(.{8}))"), F.lit(1)))
    short = t.select("tk", F.explode(grams).alias("g")).join(q.where("size(w) < 5").select("qk", F.substring("q", 1, 8).alias("g")), "g")
    pairs = long_.select("tk", "qk").unionByName(short.select("tk", "qk")).distinct()
    found = pairs.join(q.select("qk", "q"), "qk").join(t, "tk").where(F.contains("t", "q"))
    return found.select(F.col("tk").alias(key), F.col("qk").alias(quote_key))


_squeezed = squeeze


def representatives(df: DataFrame, key: str, parent: str, is_fork: str, weight: str, recent: str, least: int) -> DataFrame:
    """The rows that stand for their families, with n_forks.

    Rows that are no forks stay. A fork stays with weight >= least, or if its parent isn't among the others and it is
    the first of its family (weight, then recency, both descending, then key). n_forks: an original counts
    its family's forks, a stand-in those without itself, other forks none.
    """
    rows = df.withColumn("__k", F.lower(F.col(key).cast("string"))).withColumn("__p", F.coalesce(F.lower(F.col(parent).cast("string")), "__k"))
    originals = rows.where(~F.col(is_fork)).select(F.col("__k").alias("__p")).distinct().withColumn("__listed", F.lit(True))
    order = F.struct(F.coalesce(-F.col(weight), F.lit(float("inf"))), F.coalesce(-F.unix_micros(F.col(recent).cast("timestamp")), F.lit(2**62)), F.col(key))
    families = rows.where(F.col(is_fork)).groupBy("__p").agg(F.count("*").alias("__n"), F.min_by(key, order).alias("__first"))
    forks = rows.where(F.col(is_fork)).join(originals, "__p", "left").join(families, "__p")
    stand_in = F.col("__listed").isNull() & (F.col(key) == F.col("__first"))
    kept = forks.where((F.coalesce(F.col(weight), F.lit(0)) >= least) | stand_in).withColumn("n_forks", F.when(stand_in, F.col("__n") - 1).otherwise(0))
    own = rows.where(~F.col(is_fork)).join(families.select(F.col("__p").alias("__k"), "__n"), "__k", "left").withColumn("n_forks", F.coalesce("__n", F.lit(0)))
    return own.select(*df.columns, "n_forks").unionByName(kept.select(*df.columns, "n_forks"))


def copy_collapse(df: DataFrame, key: str, text: str, best: str) -> DataFrame:
    """One row for each stripped text: the largest best, then the smallest key; text_hash, n_identical_copies."""
    rows = df.where(F.col(text).isNotNull()).withColumn("text_hash", F.sha2(ustrip(F.col(text)), 256))
    rest = [c for c in df.columns if c not in (key, text)]
    groups = rows.groupBy("text_hash").agg(
        F.min_by(F.struct(key, *rest), F.struct(F.coalesce(-F.col(best), F.lit(2**62)), key)).alias("r"), (F.count("*") - 1).alias("n_identical_copies")
    )
    return groups.select(*[F.col("r")[c].alias(c) for c in [key, *rest]], "text_hash", "n_identical_copies")


def shared_jobs(df: DataFrame, key: str, text: str) -> DataFrame:
    """job (hash), entities (sorted), shared_by: one request for each text."""
    return df.where(F.col(text).isNotNull()).groupBy(F.sha2(text, 256).alias("job")).agg(F.array_sort(F.collect_set(key)).alias("entities"), F.count("*").alias("shared_by"))


def fan_out(answers: DataFrame, jobs: DataFrame) -> DataFrame:
    """Each job's answer for each of its entities."""
    return jobs.select("job", "shared_by", F.explode("entities").alias("entity")).join(answers, "job")


def use_class(calls: Column, imports: Column, elsewhere: Column, names: Column, mentioned: Column, has_code: Column) -> Column:
    """How an entity uses a library, the strongest first."""
    some = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0
    return F.when(~has_code, "no code").when(some(calls), "calls").when(some(imports), "imports only").when(some(elsewhere), "through another").when(some(names), "names only").when(mentioned, "mentions").otherwise("no mention")


def legend_order(df: DataFrame, c: str, neutral: list[str], unknown: str = "Unknown") -> DataFrame:
    """value, n, place: the largest category first, neutral ones after the rest; null is unknown."""
    from pyspark.sql import Window

    counts = df.groupBy(F.coalesce(c, F.lit(unknown)).alias("value")).agg(F.count("*").alias("n"))
    apart = F.col("value").isin(unknown, *neutral)
    return counts.withColumn("place", F.row_number().over(Window.orderBy(apart, F.desc("n"), "value")))  # one row for each category


def search_index(df: DataFrame, key: str, text: Column) -> DataFrame:
    """term, key: an inverted index of distinct lower-cased terms."""
    terms = F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_=.]+"), lambda t: t != ""))
    return df.select(key, F.explode(terms).alias("term"))


def search(index: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """key of the rows that have all terms."""
    hits = index.where(F.col("term").isin(*[t.lower() for t in terms]))
    return hits.groupBy(key).agg(F.count_distinct("term").alias("n")).where(F.col("n") == len(set(terms))).select(key)


def verified_answers(answers: DataFrame, entity: str, evidence: str, answer: str, shown: str, least: int = 8, unknown: str = "Can't tell") -> DataFrame:
    """entity, kept, dropped: answers whose quote stands in the shown text, letter for letter but for runs of white space.

    Back-quotes around a quote don't count. The unknown answer needs no quote and is what is left if nothing else stands;
    "Other" is kept only alone. dropped has the other answers that weren't kept.
    """
    quote, text = squeeze(F.btrim(squeeze(F.col(evidence)), F.lit("`"))), squeeze(F.col(shown))
    told = F.col(answer).isNotNull() & (F.col(answer) != unknown)
    ok = F.coalesce((F.length(quote) >= least) & F.contains(text, quote), F.lit(False))
    g = answers.groupBy(entity).agg(F.array_sort(F.collect_set(F.when(told & ok, F.col(answer)))).alias("k"), F.array_sort(F.collect_set(F.when(told & ~ok, F.col(answer)))).alias("dropped"))
    named = F.array_remove("k", "Other")
    kept = F.when(F.size("k") == 0, F.array(F.lit(unknown))).when(F.size(named) > 0, named).otherwise(F.col("k"))
    return g.select(entity, kept.alias("kept"), F.array_except("dropped", "k").alias("dropped"))
