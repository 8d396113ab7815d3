"""Operator 1: benchmark decontamination by template canonicalisation. DataFrame functions only.

Both sides are canonicalised: a token with a digit becomes a number placeholder, a unit after a number a unit
placeholder, a capitalised token, or a run of up to NAMES of them, a name placeholder (also at the begin of a sentence,
where a name can't be told from another word); longer runs are capitals or title case, not names, and are read like other
words: lower-cased, without punctuation. Runs of WINDOW canonical tokens are hashed and joined; windows of placeholders
alone never count. An item whose windows are covered to a share of least_cover or more in a document is a candidate, even
if its numbers and names were replaced. Slots are then compared: the raw values at placeholders must map one to one, in
both directions. That is judged for each shift between item and document, over the slots in the windows found at that
shift. Shifts count if they hold no slots, or if the share of consistent slot values reaches least_consistent; a candidate
is a leak if the windows of the shifts that count still reach least_cover.

Windows of the plain words (lower-cased, nothing replaced) are a second form of both sides, in the same join: it meets
copies whose case was changed, and needs no slots.

A document's window can only be met if all its tokens are tokens of benchmark windows. A sketch of those tokens, SLOTS bytes
whatever the benchmark's size, tells which may be (never a miss); only windows of such tokens are hashed and joined.
Windows of the benchmark are broadcast only if their counted bytes fit; else both sides are shuffled.

Defined cases: null or empty texts have no windows. An item of fewer tokens than WINDOW is one window of its size; one
of fewer than LEAST tokens, which many texts hold by chance, is met only by a text that holds nothing else. Items with
null ids don't count. Repeated rows and ids: a leak is reported once for each (document id, item id). Extra columns are
not read. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import sized_join

WINDOW, LEAST, NAMES = 8, 5, 3
SLOTS = 1 << 17
# Fixed unit words, after a number.
UNITS = "kg|g|mg|lb|lbs|oz|km|m|cm|mm|mi|ft|in|miles?|meters?|metres?|feet|inch(?:es)?|hours?|hrs?|minutes?|mins?|seconds?|secs?|days?|weeks?|months?|years?|dollars?|euros?|cents?|percent|liters?|litres?|l|ml|mph|kmh|apples?|degrees?"
NUMBER, UNIT, NAME, JOINED, PLAIN = "\u0001", "\u0002", "\u0003", "\u0005", "\u0006"


def apart(text: Column) -> Column:
    """Text with numbers set apart and one blank between tokens."""
    x = F.regexp_replace(text, r"([^\s\p{L}]*\d[\d.,:/]*)", " $1 ")
    return F.btrim(F.regexp_replace(x, r"\s+", " "))


def spaced(text: Column) -> Column:
    """apart() with short runs of capitalised words joined, the words of longer ones marked; canonical and raw tokens are both read from it."""
    x = apart(text)
    tokens = F.split(x, " ")
    flags = F.array_join(F.transform(tokens, lambda t: F.when(t.rlike(r"^[\"'(\[]?\p{Lu}"), "1").otherwise("0")), "")
    # a word of a run of more than NAMES capitalised ones, wherever in the run it stands
    n = NAMES + 1
    long = "|".join(f"(?<=1{{{i}}})1(?=1{{{n - 1 - i}}})" for i in range(n))
    marked = F.zip_with(tokens, F.split(F.regexp_replace(flags, long, "2"), ""), lambda t, f: F.when(f == "2", F.concat(F.lit(PLAIN), t)).otherwise(t))
    x = F.when(x.rlike(r"(?:\p{Lu}[^ ]* [\"'(\[]?){" + str(NAMES) + r"}\p{Lu}"), F.array_join(marked, " ")).otherwise(x)
    # a run of capitalised words is one token: names of one and of several words look alike
    return F.regexp_replace(x, r"(?<![^ ])([\"'(\[]?\p{Lu}[\p{L}'\-]*) (?=\p{Lu})", "$1" + JOINED)


def canonical(spaced_text: Column) -> Column:
    """spaced() text with placeholders, lower-cased, without punctuation; each token stays one token between blanks, empty if it was punctuation alone."""
    x = F.regexp_replace(spaced_text, r"(?<![^ ])[^ ]*\d[^ ]*", NUMBER)
    x = F.regexp_replace(x, r"(?<![^ ])[\"'(\[]?\p{Lu}[^ ]*", NAME)
    x = F.regexp_replace(x, f"(?<={NUMBER} )" + r"(?:(?i:" + UNITS + r")|[%€$£])\p{Punct}*(?![^ ])", UNIT)
    return F.lower(F.regexp_replace(x, r"[\p{Punct}" + PLAIN + "]+", ""))


def with_tokens(df: DataFrame, text: str) -> DataFrame:
    """Adds toks, the canonical tokens, and plain, the words as they are but for case and punctuation."""
    df = df.withColumn("toks", F.filter(F.split(canonical(spaced(F.col(text))), " "), lambda t: t != ""))
    return df.withColumn("plain", F.filter(F.split(F.lower(F.regexp_replace(apart(F.col(text)), r"\p{Punct}+", "")), " "), lambda t: t != ""))


FORMS = {0: "toks", 1: "plain"}


def windows(form: int, size: Column) -> Column:
    """Hashes of all runs of size tokens of a form, in order; none if there are fewer."""
    tokens, salt = FORMS[form], [F.lit(1)] if form else []
    n = F.size(tokens)
    at = F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(tokens, i, size), *salt))


def slot_of(token: Column) -> Column:
    return F.xxhash64(token).bitwiseAND(SLOTS - 1).cast("int")


def token_sketch(benchmark: DataFrame, item: str, text: str, form: int) -> bytes:
    """A digit for each slot, 1 where a token of a benchmark text falls; at most SLOTS numbers reach the driver."""
    rows = with_tokens(benchmark.where(F.col(item).isNotNull()).select(F.col(text).alias("t")), "t")
    held = bytearray(b"0" * SLOTS)
    for r in rows.select(F.explode(FORMS[form]).alias("token")).select(slot_of(F.col("token")).alias("slot")).distinct().collect():
        held[r["slot"]] = ord("1")
    return bytes(held)


def known_windows(form: int, size: int, sketch: bytes, whole: bool = False) -> Column:
    """Structs (doc_at, hash) of the windows() whose tokens the sketch may hold."""
    tokens, salt = FORMS[form], [F.lit(1)] if form else []
    n = F.size(tokens)
    held = F.array_join(F.transform(tokens, lambda t: F.substring(F.lit(sketch), slot_of(t) + 1, F.lit(1)).cast("string")), "").cast("binary")
    at = F.when((n == size) if whole else (n >= size), F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))
    # bound as a variable, or it would be made again for each window
    at = F.flatten(F.transform(F.array(held), lambda k: F.filter(at, lambda i: F.substring(k, i, F.lit(size)) == F.lit(b"1" * size))))
    return F.transform(at, lambda i: F.struct((i - 1).alias("doc_at"), F.xxhash64(F.slice(tokens, i, size), *salt).alias("hash")))


def item_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """item, form, size, n_windows, at, hash of each benchmark window that holds a word."""
    rows = with_tokens(benchmark.where(F.col(item).isNotNull()).select(F.col(item).alias("item"), F.col(text).alias("t")), "t")
    out = None
    for form, tokens in FORMS.items():
        size = F.least(F.lit(WINDOW), F.size(tokens))
        said = rows.where(F.size(tokens) > 0).select("item", tokens, size.alias("size"))
        said = said.select("item", tokens, "size", (F.size(tokens) - F.col("size") + 1).alias("n_windows"), F.posexplode(windows(form, F.col("size"))).alias("at", "hash"))
        empty = F.forall(F.slice(tokens, F.col("at") + 1, F.col("size")), lambda t: t.isin(NUMBER, UNIT, NAME))
        said = said.where(~empty).select("item", F.lit(form).alias("form"), "size", "n_windows", "at", "hash")
        out = said if out is None else out.unionByName(said)
    return out


def slot_values(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the raw tokens in the places of the canonical ones, null where a token is no slot."""
    df = df.withColumn("__s", spaced(F.col(text)))
    both = F.zip_with(F.split(canonical(F.col("__s")), " "), F.split("__s", " "), lambda c, r: F.struct(c.alias("c"), r.alias("r")))
    df = df.withColumn("__p", F.filter(both, lambda p: p["c"] != ""))
    bare = lambda r: F.when(F.regexp_replace(r, r"\p{Punct}+", "") == "", r).otherwise(F.lower(F.regexp_replace(r, r"^\p{Punct}+|\p{Punct}+$", "")))
    return df.withColumn(out, F.transform("__p", lambda p: F.when(p["c"].isin(NUMBER, UNIT, NAME), bare(p["r"])))).drop("__s", "__p")


def benchmark_leaks(
    docs: DataFrame, benchmark: DataFrame, least_cover: float = 0.5, least_consistent: float = 0.8,
    key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", most: int = 8 << 20,
) -> DataFrame:
    """key, item, cover, n_slots, consistent, kind of each leak; kind is exact or reparameterised."""
    items = materialize(item_windows(benchmark, item, item_text), "items")
    sizes = [tuple(r) for r in items.select("form", "size").distinct().collect()]  # at most twice WINDOW
    tokens = with_tokens(docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("row"), F.col(text).alias("t")), "t")
    sketches = {form: token_sketch(benchmark, item, item_text, form) for form in {f for f, _ in sizes} or {0}}
    hashes, hits = materialize(items.select("hash").distinct(), "hashes"), None
    for form, size in sorted(sizes) or [(0, WINDOW)]:
        found = tokens.select("doc", "row", F.explode(known_windows(form, size, sketches[form], size < LEAST)).alias("w")).select("doc", "row", "w.doc_at", "w.hash")
        found = sized_join(found, hashes, "hash", "left_semi", 16, most).select("doc", "row", F.lit(form).alias("form"), F.lit(size).alias("size"), "doc_at", "hash")
        hits = found if hits is None else hits.unionByName(found)
    hits = materialize(hits, "hits")
    # An item covers a document along diagonals: the same shift between its windows and the document's.
    met = sized_join(hits, items, ["hash", "form", "size"], "inner", 48, most).select("doc", "row", "item", "form", "at", "n_windows", "size", (F.col("doc_at") - F.col("at")).alias("shift"))
    cover = met.groupBy("doc", "row", "item", "form", "n_windows").agg(F.count_distinct("at").alias("found"))
    covered = cover.where(F.col("found") >= least_cover * F.col("n_windows")).groupBy("doc", "row", "item", "form").agg(F.max(F.col("found") / F.col("n_windows")).alias("cover"))
    covered = materialize(covered, "candidates")
    candidates, copies = covered.where("form = 0").drop("form"), covered.where("form = 1").drop("form")
    shifts = sized_join(met.where("form = 0"), materialize(candidates.select("row", "item").distinct(), "met"), ["row", "item"], "left_semi", 48, most)
    shifts = shifts.groupBy("row", "item", "n_windows", "size", "shift").agg(F.collect_set("at").alias("ats"))

    chosen = materialize(candidates.select("row").distinct(), "rows")
    wanted = sized_join(docs.select(F.xxhash64(text).alias("row"), F.col(text).alias("t")), chosen, "row", "left_semi", 16, most)
    doc_slots = materialize(slot_values(wanted, "t", "d").select("row", "d").dropDuplicates(["row"]), "docslots")
    item_slots = slot_values(benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("t")).where(F.col("item").isNotNull()), "t", "b")
    item_slots = materialize(item_slots.select("item", "b"), "itemslots")
    # sides are broadcast by their counted bytes, not by the size of their files
    pairs = sized_join(sized_join(shifts, item_slots, "item", "inner", 48, most), doc_slots, "row", "inner", 48, most)
    inside = lambda i: F.exists("ats", lambda at: (i >= at) & (i < at + F.col("size")))
    values = F.transform("b", lambda b, i: F.struct(b.alias("b"), F.coalesce(F.when(i + F.col("shift") >= 0, F.try_element_at("d", F.greatest(i + F.col("shift") + 1, F.lit(1)))), F.lit("")).alias("v"), inside(i).alias("inside")))
    values = F.array_distinct(F.transform(F.filter(values, lambda x: x["inside"] & x["b"].isNotNull()), lambda x: F.struct(x["b"].alias("b"), x["v"].alias("v"))))
    pairs = pairs.withColumn("values", values).withColumn("names", F.array_distinct(F.transform("values", lambda x: x["b"])))
    # values are distinct pairs: one is consistent if neither of its values stands in another
    pairs = pairs.withColumn("theirs", F.transform("values", lambda x: x["v"]))
    single = lambda c, x: F.size(F.filter(c, lambda y: y == x)) == 1
    pairs = pairs.withColumn("ours", F.transform("values", lambda x: x["b"]))
    once = F.size(F.filter("values", lambda x: single("ours", x["b"]) & single("theirs", x["v"])))
    pairs = pairs.select(
        "row", "item", "n_windows", "ats", F.size("names").alias("n_slots"), F.when(F.size("names") == 0, F.lit(1.0)).otherwise(once / F.size("names")).alias("share"),
        F.forall("values", lambda x: x["b"] == x["v"]).alias("same"),
    ).where(F.col("share") >= least_consistent)
    reached = lambda at: F.size(F.array_distinct(F.flatten(F.collect_list(at)))) >= least_cover * F.col("n_windows")
    judged = pairs.groupBy("row", "item", "n_windows").agg(
        F.max("n_slots").alias("n_slots"), F.max("share").alias("share"), reached("ats").alias("reached"),
        reached(F.when(F.col("same"), F.col("ats"))).alias("same"),
    ).where("reached")
    kept = candidates.join(judged, ["row", "item"]).select("doc", "item", "cover", "n_slots", "share", "same")
    kept = kept.unionByName(copies.select("doc", "item", "cover", F.lit(0).alias("n_slots"), F.lit(1.0).alias("share"), F.lit(True).alias("same")))
    # ids of documents may repeat or be null: one row for each pair
    kept = kept.groupBy("doc", "item").agg(
        F.max("cover").alias("cover"), F.max(F.coalesce("n_slots", F.lit(0))).cast("long").alias("n_slots"), F.max("share").alias("consistent"),
        F.when(F.bool_or(F.coalesce("same", F.lit(True))), "exact").otherwise("reparameterised").alias("kind"),
    )
    return kept.withColumnRenamed("doc", key).withColumnRenamed("item", item)


def leaking_rows(docs: DataFrame, leaks: DataFrame, key: str = "doc_id", most: int = 8 << 20) -> DataFrame:
    """docs without the documents that leak; a document with a null id stays unless a leak has a null id."""
    bad = materialize(leaks.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__bad")).distinct(), "bad")
    rows = docs.withColumn("__bad", F.coalesce(F.col(key).cast("string"), F.lit("")))
    return sized_join(rows, bad, "__bad", "left_anti", 48, most).drop("__bad")
