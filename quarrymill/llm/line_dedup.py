"""Operator 6: fuzzy line dedup by MinHash. DataFrame functions only.

A line's set holds its character shingles: the SHINGLE characters from every character on, hashed. The exact Jaccard
that decides a pair is over these whole sets. A signature costs a hash for each shingle it looks at, so it looks at a sample that the
content chooses: the shingles that begin a word. A line with fewer than 2 * FEW of them has a signature of all its
shingles besides, so that lines with few or no words have one as well, and pairs around the border share a kind.

The signature orders its hashes in a circle; band b is made of the ROWS hashes that follow the band's fixed point, so
two lines agree in a band with about the chance J ** ROWS, and BANDS bands catch J = 0.8 in about 99 of 100 cases, J = 0.9 in
all but a few of 100,000 (recall against all pairs is tested).
A line is compared with the least line that it shares a band with first; exact Jaccard decides and distributed
union-find joins the links. Lines that share a band have its least line in common, and are a group. In groups that then still hold
several components, each line's most promising pairs are decided and joined, and then all pairs that may be similar and are still between
different components. In a small group every line meets every other; in a large one lines meet by their differences from a reference (see
pairs_of_large_groups), which loses no pair. So every pair that shares a band is decided, ruled out by an exact bound or already joined. Before texts are compared, bitmaps of the
lines' shingles rule out pairs that can't reach the threshold; that bound is exact and loses none. The first line of each component
(least id, then position) stays.

Lines are compared trimmed and in lower case; blank lines are kept and not counted. A line's identity is a 64-bit
hash. Texts move only where the rows to keep are too many to broadcast by a checked size.

Defined cases: a null text stays null and has no lines. Documents with equal id and text are treated as one and keep
the same lines. Ids of any sortable type; a null id sorts last. Ties go to the smaller position. Empty tables give
empty results. Extra columns pass through; the names of the two counts are a parameter, and a column of docs with
such a name is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, release
from .components import connected_components, sized_join

SHINGLE, BANDS, ROWS, FEW, WORDS = 9, 6, 3, 8, 16
#: Lines of a group that all meet each other; lines that a larger group's reference is made of, about.
SMALL, SAMPLE = 64, 31
THRESHOLD = 0.8
ROW, LINE_NO, LID = "__row", "__no", "__lid"
#: No elements, and typed as never null, for which Spark sorts plain longs.
NO_HASHES = "array_remove(array(0L), 0L)"
#: The bands' fixed points, spread over the 64-bit numbers.
POINTS = [-(2**63) + (2 * b + 1) * (2**63 // BANDS) for b in range(BANDS)]


def all_hashes(line: Column) -> Column:
    """The hashes of all shingles, repeats included; a shorter line is one shingle."""
    # four bytes a character, so that a slice needs no scan; bound as a variable, or each slice would encode the line again
    at = lambda u: F.sequence(F.lit(0), F.greatest(F.floor(F.length(u) / 4).cast("int") - SHINGLE, F.lit(0)))
    cut = F.transform(F.array(F.encode(line, "UTF-32")), lambda u: F.transform(at(u), lambda i: F.xxhash64(F.substring(u, i * 4 + 1, F.lit(4 * SHINGLE)))))
    return F.element_at(cut, 1)


def sampled_hashes(line: Column) -> Column:
    """The hashes of the whole shingles that begin a word (of ASCII letters and digits)."""
    cut = F.regexp_extract_all(line, F.lit(r"(?s)\b(?=(\w.{%d}))" % (SHINGLE - 1)), F.lit(1))
    return F.array_distinct(F.transform(cut, lambda s: F.xxhash64(s)))


def with_bands(lines: DataFrame, hashes: str, kind: int, out: str) -> DataFrame:
    """Adds the BANDS keys of a signature; one with fewer hashes than ROWS uses what it has, one of none has no keys."""
    # columns of their own, as each is used more than once
    lines = lines.withColumn("__c", F.sort_array(hashes))
    lines = lines.withColumn("__m", F.sort_array(F.concat("__c", F.array(*[F.lit(p) for p in POINTS])))).withColumn("__d", F.concat("__c", "__c"))
    # as many hashes lie before point b as its place says, without the b points before it
    keys = [F.xxhash64(F.lit(kind * BANDS + b), F.slice("__d", F.array_position("__m", F.lit(p)).cast("int") - b, F.least(F.lit(ROWS), F.size("__c")))) for b, p in enumerate(POINTS)]
    return lines.withColumn(out, F.when(F.size("__c") > 0, F.array_distinct(F.array(*keys))).otherwise(F.expr(NO_HASHES))).drop("__c", "__m", "__d")


def numbered_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """ROW, who (sorts as the ids, null last), LINE_NO, LID, norm of each line that isn't blank."""
    who = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"))
    lines = docs.select(F.xxhash64(key, text).alias(ROW), who.alias("who"), F.posexplode(F.split(text, "\n")).alias(LINE_NO, "__line"))
    norm = lines.select(ROW, "who", LINE_NO, F.lower(F.btrim("__line", F.lit(" \t\r"))).alias("norm")).where("norm <> ''")
    return norm.withColumn(LID, F.xxhash64("norm"))


def sketches(texts: DataFrame) -> DataFrame:
    """LID, size (number of different shingles), a bitmap of WORDS longs with a bit for each shingle, and what its collisions
    hide: size less the bits that are set. Sums up inside the task that reads a line."""
    each = texts.select(LID, F.explode(F.array_distinct(all_hashes(F.col("norm")))).alias("h"))
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    word = F.shiftrightunsigned("h", 6).bitwiseAND(WORDS - 1)
    masks = [F.coalesce(F.bit_or(F.when(word == w, bit)), F.lit(0).cast("long")).alias(f"m{w}") for w in range(WORDS)]
    drawn = each.groupBy(LID).agg(F.count("*").alias("size"), *masks)
    return drawn.withColumn("hidden", F.col("size") - sum((F.bit_count(f"m{w}") for w in range(WORDS)), F.lit(0)))


def common_bits(x: str, y: str) -> Column:
    """The number of bits that two sketches share, from their columns (prefixes x and y)."""
    return sum((F.bit_count(F.col(f"{x}m{w}").bitwiseAND(F.col(f"{y}m{w}"))) for w in range(WORDS)), F.lit(0))


def may_be_similar(x: str, y: str, threshold: float) -> Column:
    """False only where two lines can't reach the threshold, from the columns of their sketches (prefixes x and y).

    A bit that only one has stands for at least one shingle that only it has, so the common ones are no more than the bits
    that both have and what collisions hide.
    """
    both = common_bits(x, y)
    sizes = F.col(f"{x}size"), F.col(f"{y}size")
    fits = F.least(*sizes) >= threshold * F.greatest(*sizes)
    return fits & ((1 + threshold) * (F.least(f"{x}hidden", f"{y}hidden") + both) >= threshold * (sizes[0] + sizes[1]) - 1e-6)


def likeness(x: str, y: str) -> Column:
    """A guess of two lines' Jaccard from the columns of their sketches (prefixes x and y)."""
    both = common_bits(x, y)
    return both / (F.col(f"{x}size") + F.col(f"{y}size") - both)


def plausible_pairs(pairs: DataFrame, drawn: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that may be similar by their sketches, with their sizes and near, a guess of their Jaccard."""
    for p, c in (("x", "a"), ("y", "b")):
        end = drawn.select(F.col(LID).alias(c), *[F.col(n).alias(p + n) for n in drawn.columns if n != LID])
        pairs = sized_join(pairs, end, c, "inner", 24 + 8 * WORDS)
    return pairs.where(may_be_similar("x", "y", threshold)).select("a", "b", "xsize", "ysize", likeness("x", "y").alias("near"))


def similar_pairs(texts: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard of threshold or more. Texts are moved, not their sets, which are eight times as large."""
    pairs = pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, much work
    a, b = (texts.select(F.col(LID).alias(c), F.col("norm").alias(t)) for c, t in (("a", "s"), ("b", "t")))
    met = sized_join(sized_join(pairs, a, "a", "inner", 48), b, "b", "inner", 48)
    met = met.withColumn("common", F.size(F.array_intersect(all_hashes(F.col("s")), all_hashes(F.col("t")))))
    return met.where(F.col("common") >= threshold * (F.col("xsize") + F.col("ysize") - F.col("common"))).select("a", "b")


def open_groups(met: DataFrame, comp: DataFrame) -> DataFrame:
    """LID, lo, comp, m of the lines that share a band whose least line is lo, m of them, where they are in several components."""
    members = sized_join(met, comp.withColumnRenamed("node", LID), LID, "left", 32)
    members = materialize(members.select(LID, "lo", F.coalesce("root", LID).alias("comp")), "members")
    groups = members.groupBy("lo").agg(F.count("*").alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("lo", "m")
    return materialize(sized_join(members, materialize(groups, "groups"), "lo", "inner", 24), "held")


def pairs_of_small_groups(held: DataFrame, drawn: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of lines of a group of SMALL lines or fewer that have different components and whose sketches allow the
    threshold, with their sizes and near. A line meets fewer than SMALL others of a group."""
    few = materialize(sized_join(held.where(F.col("m") <= SMALL), drawn, LID, "inner", 24 + 8 * WORDS), "few")
    ends = lambda p: few.select("lo", *[F.col(c).alias(p + c) for c in (LID, "comp", *drawn.drop(LID).columns)])
    met = ends("x").join(ends("y").hint("merge"), "lo").where((F.col(f"x{LID}") > F.col(f"y{LID}")) & (F.col("xcomp") != F.col("ycomp")) & may_be_similar("x", "y", threshold))
    return met.select(F.col(f"x{LID}").alias("a"), F.col(f"y{LID}").alias("b"), "xsize", "ysize", likeness("x", "y").alias("near")).distinct()


def differences(held: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """lo, LID, comp, size, diff, e of the lines of groups of more than SMALL lines.

    diff are the shingles that a line and its group's reference do not share: those only the line has, then those only the
    reference has. The reference holds the shingles of more than half of about SAMPLE lines of the group; it may be any set, as it only
    decides how short the differences are. It has at most twice as many shingles as those lines have on average.
    """
    many = held.where(F.col("m") > SMALL)
    some = materialize(many.where(F.pmod(F.xxhash64(LID, "lo"), F.col("m")) < SAMPLE).select(LID, "lo"), "sample")
    lines = texts.select(LID, "norm")
    each = some.join(lines.hint("merge"), LID).select("lo", F.explode(F.array_distinct(all_hashes(F.col("norm")))).alias("h"))
    held_by = each.groupBy("lo", "h").agg(F.count("*").alias("c")).join(some.groupBy("lo").agg(F.count("*").alias("n")).hint("merge"), "lo")
    refs = materialize(held_by.where("2 * c > n").groupBy("lo").agg(F.collect_list("h").alias("ref")), "references")
    few = refs.agg(F.coalesce(F.sum(F.size("ref") * 8 + 32), F.lit(0))).first()[0] <= 8 << 20
    own = many.join(lines.hint("merge"), LID).join(F.broadcast(refs) if few else refs.hint("merge"), "lo", "left")
    own = own.select("lo", LID, "comp", F.array_distinct(all_hashes(F.col("norm"))).alias("h"), F.coalesce("ref", F.expr(NO_HASHES)).alias("ref"))
    diff = F.concat(F.sort_array(F.array_except("h", "ref")), F.sort_array(F.array_except("ref", "h")))
    own = own.select("lo", LID, "comp", F.size("h").alias("size"), diff.alias("diff"))
    return materialize(own.withColumn("e", F.size("diff") - (1 - threshold) / (1 + threshold) * F.col("size")), "differences")


def pairs_of_large_groups(held: DataFrame, texts: DataFrame, drawn: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(sure, other): pairs (a, b) of a group of more than SMALL lines with different components, with their sizes and near.

    Two sets are similar exactly if twice the number of elements that their differences share is at least the sum of their e. So the
    line of a group with the least e is similar to all whose e is at most the negative of its own: the sure pairs. A
    line beyond that must share elements of its difference with a similar one, at least half of the sum, and
    of the shared ones the first in the differences' order has the others behind it. So lines meet by the
    elements that come early enough, which few lines share if they differ from the reference each in its own way. No pair that can reach the threshold is lost.
    """
    slack, ratio = 1e-5, (1 - threshold) / (1 + threshold) * (1 + 1 / max(threshold, 0.01))
    diffs = differences(held, texts, threshold)
    cores = materialize(diffs.groupBy("lo").agg(F.min(F.struct("e", LID, "size", F.size("diff").alias("d"), "comp")).alias("core")), "cores")
    own = sized_join(diffs, cores, "lo", "inner", 64).withColumn("d", F.size("diff"))
    sure = own.where((F.col("e") + F.col("core.e") <= slack) & (F.col("comp") != F.col("core.comp")))
    one = F.col(LID) > F.col(f"core.{LID}")
    order = lambda c: (F.when(one, F.col(c)).otherwise(F.col(f"core.{c}")), F.when(one, F.col(f"core.{c}")).otherwise(F.col(c)))
    (a, b), (s, t) = order(LID), order("size")
    apart, sizes = F.col("d") + F.col("core.d"), F.col("size") + F.col("core.size")
    sure = sure.select(a.alias("a"), b.alias("b"), s.cast("long").alias("xsize"), t.cast("long").alias("ysize"), ((sizes - apart) / (sizes + apart)).alias("near")).distinct()

    def early(rows: DataFrame, least: Column, p: str) -> DataFrame:
        """The elements of a line's difference that may be the first shared one; left: how many come from there on. least: the least e of a partner."""
        shared = F.greatest(F.lit(1.0), (F.col("e") + least) / 2 - slack, F.col("d") - ratio * F.col("size") - slack)
        at = F.posexplode(F.slice("diff", F.lit(1), F.greatest(F.lit(0), F.col("d") - F.ceil(shared).cast("int") + 1))).alias("i", "h")
        cut = rows.select("lo", F.col(LID), "comp", "size", "e", "d", at).withColumn("left", F.col("d") - F.col("i")).drop("i", "d")
        return cut.select("lo", "h", *[F.col(c).alias(p + c) for c in (LID, "comp", "size", "e", "left")])

    starts = early(own.where(F.col("e") + F.col("core.e") > -slack), F.col("core.e"), "x")
    meets = early(own, F.abs("core.e"), "y")
    fits = F.least("xsize", "ysize") >= threshold * F.greatest("xsize", "ysize")
    fits &= F.least("xleft", "yleft") >= (F.col("xe") + F.col("ye")) / 2 - slack
    met = starts.join(meets.hint("merge"), ["lo", "h"]).where((F.col("xcomp") != F.col("ycomp")) & fits)
    ends = (F.col(f"x{LID}"), F.col(f"y{LID}"))
    met = materialize(met.select(F.greatest(*ends).alias("a"), F.least(*ends).alias("b")).distinct(), "near")
    return materialize(sure, "sure"), plausible_pairs(met, drawn, threshold)


def best_pairs(pairs: DataFrame) -> DataFrame:
    """Each line's pairs of the best guess with a lesser and with a greater line; one alone would join mutual neighbours only.
    Maxima combine before the shuffle."""
    pair = F.struct("near", "a", "b", "xsize", "ysize").alias("pair")
    ends = pairs.select(F.posexplode(F.array("a", "b")).alias("side", "end"), pair)
    return ends.groupBy("side", "end").agg(F.max("pair").alias("pair")).select("pair.*").distinct().select(*pairs.columns)


def open_pairs(pairs: DataFrame, decided: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs whose ends aren't in one component, without the decided ones."""
    rest = sized_join(pairs, decided.select("a", "b"), ["a", "b"], "left_anti", 32)
    for c in ("a", "b"):
        rest = sized_join(rest, comp.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left", 32)
    return rest.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(*pairs.columns)


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """ROW and drop (array of line numbers) of the documents that lose lines."""
    lines = numbered_lines(docs, key, text)
    some = lines.withColumn("s", sampled_hashes(F.col("norm"))).withColumn("n", F.size("s"))
    some = some.withColumn("h", F.when(F.col("n") < 2 * FEW, F.array_distinct(all_hashes(F.col("norm")))).otherwise(F.expr(NO_HASHES))).withColumn("s", F.when(F.col("n") >= FEW, F.col("s")).otherwise(F.expr(NO_HASHES)))
    some = with_bands(with_bands(some, "s", 0, "x"), "h", 1, "y")
    occurrences = materialize(some.select(ROW, "who", LINE_NO, LID, "norm", F.concat("x", "y").alias("bands")), "lines")
    # rows of one line have the same keys, so a band that different lines share has a least and a greatest one; both combine before the shuffle
    bands = occurrences.select(LID, F.explode("bands").alias("band"))
    shared = materialize(bands.groupBy("band").agg(F.min(LID).alias("lo"), F.max(LID).alias("hi")).where("lo <> hi").select("band", "lo"), "shared")
    met = materialize(sized_join(bands, shared, "band", "inner", 32).select(LID, "lo").distinct(), "met")
    # a line and the least of all that it shares a band with
    partners = materialize(met.groupBy(LID).agg(F.min("lo").alias("lo")), "partners")
    found = sized_join(occurrences.select(LID, "norm"), partners.select(LID), LID, "left_semi", 16).dropDuplicates([LID])
    texts = materialize(found, "linetexts")
    drawn = materialize(sketches(texts), "sketches")
    near = plausible_pairs(partners.where(f"lo <> {LID}").select(F.col(LID).alias("a"), F.col("lo").alias("b")), drawn, threshold)
    links = materialize(similar_pairs(texts, near, threshold), "links")
    comp = materialize(connected_components(links, "a", "b"), "comp")

    # what that left open
    held = open_groups(met, comp)
    sure, other = pairs_of_large_groups(held, texts, drawn, threshold)
    crossing = materialize(pairs_of_small_groups(held, drawn, threshold).unionByName(other), "crossing")
    release(shared, met, partners, drawn)
    # lines that are near copies of many others join through their best pairs, so that few pairs stay open; then all open ones are decided
    best = materialize(best_pairs(crossing).unionByName(sure).dropDuplicates(["a", "b"]), "best")
    for pairs in (best, None):
        more = materialize(similar_pairs(texts, open_pairs(crossing, best, comp) if pairs is None else pairs, threshold), "links")
        if more.limit(1).count():
            known = comp.select(F.col("node").alias("a"), F.col("root").alias("b"))
            comp = materialize(connected_components(known.unionByName(more), "a", "b"), "comp")
    release(crossing, best, texts)

    # the lines that occur again, as themselves or in another form
    counted = occurrences.groupBy(LID).agg(F.count("*").alias("n"))
    again = sized_join(counted, comp.withColumnRenamed("node", LID), LID, "left", 32).where("n > 1 or root is not null")
    again = materialize(again.select(LID, F.coalesce("root", LID).alias("comp")), "again")
    repeated = materialize(sized_join(occurrences.select(ROW, "who", LINE_NO, LID), again, LID, "inner", 32).select(ROW, LINE_NO, "comp", "who"), "repeated")
    release(occurrences)
    # minima combine before the shuffle; written, so that a hot component can be split in the join
    first = materialize(repeated.groupBy("comp").agg(F.min(F.struct("who", ROW, LINE_NO)).alias("first")).select("comp", F.col(f"first.{ROW}").alias("r"), F.col(f"first.{LINE_NO}").alias("l")), "first")
    gone = sized_join(repeated.drop("who"), first, "comp", "inner", 48).where((F.col(ROW) != F.col("r")) | (F.col(LINE_NO) != F.col("l")))
    return gone.groupBy(ROW).agg(F.collect_set(LINE_NO).alias("drop"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """docs with the kept lines as text, and two counts (long): of lines, and of dropped ones."""
    row, gone, parts = (free_name(docs, x) for x in ("row", "gone", "parts"))
    drops = materialize(dropped_lines(docs, key, text, threshold).select(F.col(ROW).alias(row), F.col("drop").alias(gone)), "drops")
    rows = docs.withColumn(row, F.xxhash64(key, text))
    size = drops.agg(F.coalesce(F.sum(F.size(gone) * 8 + 64), F.lit(0))).first()[0]
    rows = rows.join(F.broadcast(drops) if size <= 32 << 20 else drops.hint("merge"), row, "left")
    rows = rows.withColumn(parts, F.split(text, "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    kept = F.array_join(F.transform(left, lambda i: F.element_at(parts, i + 1)), "\n")
    full = F.filter(parts, lambda x: F.btrim(x, F.lit(" \t\r")) != "")
    rows = rows.withColumns({
        counts[0]: F.when(F.col(text).isNull(), 0).otherwise(F.size(full)).cast("long"),
        counts[1]: F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long"),
        text: F.when(F.col(gone).isNull() | F.col(text).isNull(), F.col(text)).otherwise(kept),
    })
    return rows.drop(row, gone, parts)
