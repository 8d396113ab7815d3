"""Operator 13: what each filter of a chain removes under every order of the chain.

Documents are read once, into a table of counts by part and by the set of filters that they fail. States are the
subsets of filters that ran already. An edge adds one filter and removes the documents that fail it and nothing in
the state. Paths are counted forward (orders that reach a state) and backward (orders that leave it) over the subset
lattice; forward x backward of an edge is the number of orders that use it, which weights its removals for the
Shapley sums. The steps of a single order are the same edges, one after another.

The lattice has 2^n states and n * 2^(n-1) edges for n filters, whatever the data. Failure sets are whole numbers, bit
i for filter i.

Defined cases: null texts are empty; a null part is the empty string; null keys fail no duplicate filter and make
nothing else fail it; rows that repeat key and text are equally first, so none of them fails it. A document with
several labels counts as good (toxic) if any of them says so. Empty tables give no rows.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

WHITE = r"[\x20\x09-\x0D]+"


def text_filters(text: Column, words: Column) -> list[Column]:
    """Whether a text fails the filters on length, repetition, capitals and symbols; words are all of its words."""
    n = F.size(words)
    return [
        n < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n,
        100 * (F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))) > 2 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def lattice(names: str) -> list[tuple[int, int, int, int]]:
    """(state, filter, its bit, orders that use the edge) for each edge, by path counts from both ends."""
    n = len(names)
    states = sorted(range(1 << n), key=int.bit_count)
    forward, backward = [0] * (1 << n), [0] * (1 << n)
    forward[0] = backward[-1] = 1
    for s in states:
        for f in range(n):
            if not s >> f & 1:
                forward[s | 1 << f] += forward[s]
    for s in reversed(states):
        for f in range(n):
            if not s >> f & 1:
                backward[s] += backward[s | 1 << f]
    return [(s, f, 1 << f, forward[s] * backward[s | 1 << f]) for s in states for f in range(n) if not s >> f & 1]


def failure_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: documents by the set of filters they fail. Whole texts are read once and stay in place."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))).withColumn("words", F.filter(F.split("text", WHITE), lambda w: w != ""))
    own = text_filters(F.col("text"), F.col("words"))
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(own)), F.lit(0))
    seen = materialize(rows.select("id", "part", "hash", mask.alias("mask")), "failures")
    # the pair is rarely hot, the hash alone may be; minima combine before their shuffle
    first = seen.where("id IS NOT NULL").groupBy("hash").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    told = seen.join(first, ["hash", "id"], "left").join(known, "id", "left")
    last = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 1 << len(own)).otherwise(0)
    one = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return told.groupBy("part", (F.col("mask") + last).alias("mask")).agg(F.count("*").alias("n"), one("good").alias("good"), one("toxic").alias("toxic"))


def order_audit(counts: DataFrame, names: str = "ABCDE") -> DataFrame:
    """One row for each part, order and step; counts is part, mask, n, good, toxic."""
    n = len(names)
    edges = F.explode(F.from_json(F.lit(json.dumps(lattice(names))), "array<array<bigint>>")).alias("e")
    # a part has at most 2^n rows here
    each = counts.select("part", "mask", "n", "good", "toxic", edges).select("*", *[F.col("e")[i].cast("int").alias(c) for i, c in enumerate(("state", "filter", "bit"))], F.col("e")[3].alias("orders"))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    before = F.col("mask").bitwiseAND(F.col("state")) != 0
    total = lambda condition, c="n": F.sum(F.when(condition, F.col(c)).otherwise(0))
    edge = each.groupBy("part", "state", "filter", "orders").agg(
        total(~fails & ~before).alias("kept"), total(fails & ~before).alias("removed"), total(fails & before).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~before, "good").alias("good_lost"), total(fails & ~before, "toxic").alias("toxic_lost"),
    )
    shapley = edge.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    steps = []
    for order in permutations(range(n)):
        state = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(names[i] for i in order), step, state, f))
            state |= 1 << f
    walk = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, filter int")
    # n! * n rows, whatever the data
    out = edge.join(shapley, ["part", "filter"]).join(F.broadcast(walk), ["state", "filter"])
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    return order_audit(failure_counts(docs, labels, **columns))
