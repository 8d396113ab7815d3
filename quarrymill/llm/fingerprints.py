"""Operator 12: document fingerprints from closed syncmers, and how much of them an edit or the next document keeps.

Letters of the scheme are tokens: runs of up to LONGEST characters without white space, and single characters of
scripts that write without spaces. A k-mer is K tokens in a row. It is chosen if the least of its inner substrings
(S tokens in a row, by a hash) lies at one of its two edges. That depends on nothing outside the k-mer, so a passage
has the same anchors wherever it stands. Every anchor is kept: an item is its hash (32 bits) beside its distance from
the anchor before it (in tokens, 255 at most), which makes matching positional and yet free of shifts. The
fingerprint writes the items in order, ten hexadecimal digits each. Likeness is twice the common items by the items
of both (distinct ones). Texts of fewer than SHORT tokens, where few k-mers survive an edit, have each token as an anchor too, at distance 0.

The edited text takes its end from the next document in ascending key. The order is global, yet no task sees all
rows: cuts drawn from a bounded sample of keys split it into blocks of about BLOCK rows, the first row of each block is
also sent to the block before it, and a window looks ahead inside its block. Rows of one key are told apart by the
hash of their text, so a hot key is split too. Each text is shuffled once.

Defined cases: null texts count as empty and have an empty fingerprint; two empty fingerprints are alike (1), an
empty one is unlike others (0). Null keys come first. Repeated rows follow each other. A lone row is its own next. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K, S, LONGEST, SHORT = 5, 2, 16, 20
BLOCK, MOST_CUTS = 256, 1 << 14
_ALONE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
TOKEN = rf"[{_ALONE}]|[^\s{_ALONE}]{{1,{LONGEST}}}"


def _bind(value: Column, body) -> Column:
    """body(value), with value worked out once: lambdas know no common subexpressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def items(text: Column) -> Column:
    """The items of a text in order: distance << 32 | hash."""
    none = F.array().cast("array<bigint>")
    grams = lambda t: F.transform(t, lambda x, i: F.xxhash64(x, *[F.get(t, i + j) for j in range(1, S)]))
    last = K - S  # the offset of a k-mer's last inner substring

    def chosen(g):  # g has a substring for each token; those that run over the end are met by no k-mer
        inner = lambda i: F.least(*[F.get(g, i + j) for j in range(1, last)])
        return F.filter(F.sequence(F.lit(0), F.size(g) - K), lambda i: F.least(F.get(g, i), F.get(g, i + last)) <= inner(i))

    def anchors(t):
        spread = lambda g, at: F.transform(at, lambda i, j: _item(F.xxhash64(*[F.get(g, i + o) for o in [*range(0, last, S), last]]), i - F.coalesce(F.get(at, j - 1), F.lit(-1))))
        long = F.when(F.size(t) >= K, _bind(grams(t), lambda g: _bind(chosen(g), lambda at: spread(g, at)))).otherwise(none)
        return F.when(F.size(t) >= SHORT, long).otherwise(F.concat(long, F.transform(t, lambda x: _item(F.xxhash64(x), F.lit(0)))))

    return _bind(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)), anchors)


def _item(hashed: Column, distance: Column) -> Column:
    return F.shiftleft(F.least(distance, F.lit(255)).cast("long"), 32).bitwiseOR(hashed.bitwiseAND(F.lit(0xFFFFFFFF)))


def written(found: Column) -> Column:
    """Items as text, ten hexadecimal digits each; read back by conv(..., 16, 10)."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(both == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def _cuts(keys: DataFrame, kind: str) -> Column | None:
    """Sorted keys that begin the blocks, the least key among them; at most MOST_CUTS, however many rows there are."""
    rows, least = keys.agg(F.count("*"), F.min("at")).first()
    if not rows:
        return None
    want = min(MOST_CUTS, -(-rows // BLOCK))
    drawn = keys.orderBy(F.xxhash64("at"), "at").limit(8 * want).collect() if want > 1 else []
    drawn = sorted({tuple(r["at"]) for r in drawn} | {tuple(least)}, key=lambda x: (x[0] is not None, *x) if x[0] is not None else (False, 0, x[1]))
    step = -(-len(drawn) // want)
    return F.from_json(F.lit(json.dumps([dict(zip(("id", "hash"), x, strict=True)) for x in drawn[::step]])), f"array<struct<id:{kind},hash:bigint>>")


def _block(at: Column, cuts: Column) -> Column:
    """How many cuts are at or below at, less one, by halving."""
    n = F.size(cuts)
    start = F.struct(F.lit(0).alias("low"), n.alias("high"))  # cuts before low are at or below, those from high on above

    def halve(s, _):
        mid = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = F.get(cuts, mid) <= at
        return F.when(s["low"] >= s["high"], s).when(below, F.struct((mid + 1).alias("low"), s["high"].alias("high"))).otherwise(F.struct(s["low"].alias("low"), mid.alias("high")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(MOST_CUTS.bit_length())), start, halve, lambda s: s["low"] - 1)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_items for each row of docs."""
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.select("id", "text", F.struct(F.col("id"), F.xxhash64("text").alias("hash")).alias("at"))
    cuts = _cuts(rows.select("at"), kind)
    if cuts is None:
        cuts = F.from_json(F.lit("[]"), f"array<struct<id:{kind},hash:bigint>>")
    last = F.size(cuts) - 1
    own = _block(F.col("at"), cuts)
    first = F.get(cuts, F.col("own")) == F.col("at")  # begins its block, so the block before it must see it too
    seats = F.when(first, F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("guest")), F.struct(F.when(F.col("own") == 0, last).otherwise(F.col("own") - 1).alias("block"), F.lit(True).alias("guest"))))
    seats = seats.otherwise(F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("guest"))))
    seated = rows.withColumn("own", own).select("id", "text", "at", F.explode(seats).alias("seat")).select("id", "text", "at", "seat.block", "seat.guest")
    read = seated.repartition("block").withColumn("items", items(F.col("text")))
    ahead = lambda c: F.expr(f"lead({c}) OVER (PARTITION BY block ORDER BY guest, at)")
    paired = read.select("id", "text", "items", "guest", ahead("text").alias("next"), ahead("items").alias("next_items")).where("NOT guest")
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = paired.select("*", n.cast("long").alias("n_chars"), F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next", F.lit(1), cut)).alias("edited"))
    edited = edited.select("*", items(F.col("edited")).alias("edited_items"))
    return edited.select(
        F.col("id").alias(key), "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        written(F.col("items")).alias("fingerprint"), written(F.col("edited_items")).alias("edited_fingerprint"),
        likeness(F.col("items"), F.col("edited_items")).alias("near_edited"), likeness(F.col("items"), F.col("next_items")).alias("near_next"),
        F.size("items").alias("n_items"),
    )
