"""Operator 3: exact Jaccard join of documents on n-gram sets, as a blocked sparse product of the incidence matrix.

Rows of the matrix are distinct sets (documents with the same set are one row), columns are n-grams. Two rows link
when overlap >= threshold * union, so the overlap must reach need = ceil(t / (1 + t) * (n + m)): a bound from the
sizes alone. If the n-grams of every row are put into one global order, the first shared one must stand early
enough in both rows to leave room for need shared ones. So only each row's first n - ceil(t * n) + 1 entries enter
the product's first pass (rare n-grams first, by a bounded count sketch; any order is correct, a good one is fast).

1. The sketch and each document's identity (one pass over the texts).
2. Leading entries, sorted by n-gram. A column with one row is dropped. In the others the row with the earliest
   place is the hub.
3. Every row is paired with its hubs. Pairs whose shared leading entries leave too little for the bound are dropped;
   for the others the whole rows are read again and the overlap is exact.
4. Distributed union-find. Columns whose rows now lie in one component are done. In the others, rows outside the
   hub's component are paired with all rows of the column that lie in other components, and the pairs' overlaps
   are accumulated over the columns; those under the bound are dropped, the others verified as in 3. No pair that
   could join two components is left out, and pairs inside a component aren't needed.

Thus a group of thousands of near copies costs its size, not its square, and the components are exact. Identities
and n-grams are 64-bit hashes.

Defined cases: null, empty and blank texts have no n-grams and link with nothing; one to four words are one n-gram.
Repeated rows and copies share an identity and so a component. A null id takes part but never names a component
unless all ids of it are null. Very long texts are whole. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components, sized_join
from .shingles import blocks_of, fingerprint, shingle_sets

SLOTS, CHUNK = 1 << 23, 1 << 15
TIMES, UNION = 100, 75  # link when 100 * overlap >= 75 * union


def need(n, m, times: int = TIMES, union: int = UNION):
    """The least overlap at which sets of n and m elements link."""
    return -((-union * (n + m)) // (times + union))


def identities(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of two kinds: key, fp, n for each document; chunk, counts for each part of a partition's sketch."""
    kind = dict(docs.dtypes)[key]

    def work(batches):
        import pyarrow as pa

        total = np.zeros(SLOTS, dtype="uint16")
        names = [key, "fp", "n", "chunk", "counts"]
        kind = None
        for batch in batches:
            kind, fps, sizes = batch.column(0).type, [], []
            for _, texts in blocks_of(batch.column(1)):
                for found in shingle_sets(texts):
                    fps.append(fingerprint(found) if len(found) else None)
                    sizes.append(len(found))
                    slots = (found & np.uint64(SLOTS - 1)).astype("int64")
                    total[slots] += total[slots] < 255  # a text counts once for a slot
            none = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names)
        if kind is not None and total.any():
            n = SLOTS // CHUNK
            parts = [total[i * CHUNK : (i + 1) * CHUNK].astype("uint8").tobytes() for i in range(n)]
            yield pa.RecordBatch.from_arrays([pa.nulls(n, kind), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(parts, pa.binary())], names)

    return materialize(docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, fp long, n long, chunk int, counts binary"), "ids")


def sketch(rows: DataFrame) -> np.ndarray:
    """A number from 0 to 255 that grows with the rows each slot's n-grams have (12 steps for each doubling); SLOTS bytes."""

    def add(table):
        import pyarrow as pa

        total = np.zeros(CHUNK, dtype="uint64")
        for x in table["counts"]:
            total += np.frombuffer(x.as_py(), dtype="uint8")
        return pa.table({"chunk": table["chunk"][:1], "counts": pa.array([np.minimum(np.log2(1.0 + total) * 12, 255).astype("uint8").tobytes()], pa.binary())})

    got = rows.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInArrow(add, "chunk int, counts binary").toArrow()
    out = np.zeros(SLOTS, dtype="uint8")
    for chunk, counts in zip(got["chunk"].to_pylist(), got["counts"], strict=True):
        out[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(counts.as_py(), dtype="uint8")
    return out


def leading(docs: DataFrame, text: str, held) -> DataFrame:
    """gram, fp, n, place of each row's leading entries, rare n-grams first; held is the broadcast sketch."""

    def work(batches):
        import pyarrow as pa

        counts, seen = held.value, set()
        for batch in batches:
            for _, texts in blocks_of(batch.column(0)):
                grams, fps, sizes, places = [], [], [], []
                for found in shingle_sets(texts):
                    n = len(found)
                    if n < 2 or (fp := fingerprint(found)) in seen:
                        continue  # a set of one links only with the same set
                    if len(seen) < 500_000:
                        seen.add(fp)
                    order = np.lexsort((found, counts[(found & np.uint64(SLOTS - 1)).astype("int64")]))
                    first = n - -(-UNION * n // TIMES) + 1
                    grams.append(found[order[:first]])
                    fps.append(np.full(first, fp, dtype="int64"))
                    sizes.append(np.full(first, n, dtype="int32"))
                    places.append(np.arange(first, dtype="int32"))
                if grams:
                    cols = [np.concatenate(grams).view("int64"), *(np.concatenate(x) for x in (fps, sizes, places))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["gram", "fp", "n", "place"])

    return docs.select(text).mapInArrow(work, "gram long, fp long, n int, place int")


def shared_columns(entries: DataFrame, partitions: int) -> DataFrame:
    """Entries of n-grams that two rows or more have, each with its column's hub: hub, hub_n, hub_place."""

    def work(batches):
        import pyarrow as pa

        names = ["gram", "fp", "n", "place", "hub", "hub_n", "hub_place"]
        last, last_hub, sent = None, None, False  # the entry before, its column's hub, and whether it went out
        for batch in batches:
            columns = [np.asarray(batch.column(i)) for i in range(4)]
            if last is not None:
                columns = [np.concatenate([[x], c]).astype(c.dtype) for x, c in zip(last, columns, strict=True)]
            g, f = columns[:2]
            if not len(g):
                continue
            keep = np.ones(len(g), dtype=bool)
            keep[1:] = (g[1:] != g[:-1]) | (f[1:] != f[:-1])
            g, f, n, p = columns = [c[keep] for c in columns]
            new = np.ones(len(g) + 1, dtype=bool)
            new[1:-1] = g[1:] != g[:-1]
            head = np.flatnonzero(new[:-1])[np.cumsum(new[:-1]) - 1]
            hubs = [c[head] for c in (f, n, p)]
            if last is not None:  # the first run goes on from the batch before
                for column, value in zip(hubs, last_hub, strict=True):
                    column[head == 0] = value
            out = ~new[:-1] | ~new[1:]
            was = sent and last is not None
            sent = was if len(g) == 1 and last is not None else bool(out[-1])
            last, last_hub = [c[-1] for c in columns], [c[-1] for c in hubs]
            if was:
                out[0] = False
            yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in (*columns, *hubs)], names)

    sorted_ = entries.withColumn("at", F.col("place") / F.col("n")).repartition(partitions, "gram").sortWithinPartitions("gram", "at", "fp")
    return sorted_.select("gram", "fp", "n", "place").mapInArrow(
        work, "gram long, fp long, n int, place int, hub long, hub_n int, hub_place int"
    )


def fits(n, m, i, j):
    """The size bounds, and room for enough shared entries from places i and j on (Columns)."""
    return (F.lit(TIMES) * F.least(n, m) >= F.lit(UNION) * F.greatest(n, m)) & (F.least(n - i, m - j) >= least_overlap(n, m))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact overlap reaches the bound."""
    a, b = sets.select(F.col("fp").alias("a"), F.col("grams").alias("x")), sets.select(F.col("fp").alias("b"), F.col("grams").alias("y"))
    overlap = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - overlap
    return pairs.join(a, "a").join(b, "b").where(TIMES * overlap >= UNION * union).select("a", "b")


def least_overlap(n, m):
    """need() of two Columns."""
    return F.ceil(F.lit(UNION) * (n + m) / F.lit(float(TIMES + UNION)) - 1e-9)


def others(n):
    """How many entries of a row of n aren't leading (a Column)."""
    return F.ceil(F.lit(UNION) * n / F.lit(float(TIMES)) - 1e-9) - 1


def worth_a_product(pairs: DataFrame, lead: DataFrame) -> DataFrame:
    """The pairs whose overlap can still reach the bound, by what their leading entries share.

    Of the row whose leading entries end first, shared entries are either leading in both or among the
    ceil(t * n) - 1 others, so the overlap is at most the shared leading ones and the larger of those numbers.
    """
    a = lead.select(F.col("fp").alias("a"), F.col("n").alias("an"), F.col("grams").alias("x"))
    b = lead.select(F.col("fp").alias("b"), F.col("n").alias("bn"), F.col("grams").alias("y"))
    most = F.size(F.array_intersect("x", "y")) + others(F.greatest("an", "bn"))
    return pairs.join(a, "a").join(b, "b").where(most >= least_overlap(F.col("an"), F.col("bn"))).select("a", "b")


def pair_sets(docs: DataFrame, ids: DataFrame, pairs: DataFrame, key: str, text: str) -> DataFrame:
    """fp, grams of every set in pairs, read again from one document each."""
    wanted = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
    # a null id counts as the empty text, so documents without ids aren't lost
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    named = ids.where("fp is not null").groupBy("fp").agg(F.min(name).alias("__name")).join(wanted, "fp")
    named = materialize(named.select("fp", "__name"), "named")
    texts = sized_join(docs.select(name.alias("__name"), text), named.select("__name").distinct(), "__name", "left_semi", 32)
    sets = member_sets(texts, key, text).join(named.select("fp"), "fp", "left_semi").dropDuplicates(["fp"])
    return materialize(sets, "sets")


def member_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """fp, grams array<long> of each row of docs."""

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            for _, texts in blocks_of(batch.column(0)):
                found = shingle_sets(texts)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype("int32")
                flat = np.concatenate(found).view("int64") if found else np.zeros(0, dtype="int64")
                grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array([fingerprint(x) for x in found], pa.int64()), grams], ["fp", "grams"])

    return docs.select(text).mapInArrow(work, "fp long, grams array<long>")


def feasible(n, m, i, j, k, l):
    """fits() for the first shared places, and whether the shared leading entries k and l can suffice (Columns)."""
    return fits(n, m, i, j) & (F.least(k, l) + others(F.greatest(n, m)) >= least_overlap(n, m))


def crossing_pairs(placed: DataFrame, block_rows: int = 512, part_rows: int = 8192) -> DataFrame:
    """Pairs (a, b) of different components that share columns enough: the blocked product.

    Rows that lie outside the component of some column's hub are dealt to blocks by their fullest column, a full column
    to several. Each block gets the rows of its columns that could pair with one of its own, in parts by hash; a task
    multiplies one block with one part, accumulates the overlaps and keeps the pairs that reach the bound.
    """
    full = placed.groupBy("gram").agg(F.count("*").alias("m"))
    strays = placed.where("comp <> hub_comp").select("fp").distinct()
    rows = placed.join(strays, "fp", "left_semi").drop("hub_comp")
    home = rows.select("fp", "gram").join(full, "gram").groupBy("fp").agg(F.max(F.struct("m", "gram")).alias("h"))
    home = materialize(home.select("fp", "h.m", "h.gram"), "home")
    size = home.agg(F.count("*").alias("n"), F.coalesce(F.max("m"), F.lit(0)).alias("m")).first()
    blocks, parts = max(24, -(-size["n"] // block_rows)), max(1, -(-size["m"] // part_rows))
    salt = F.pmod(F.xxhash64("fp"), F.ceil(F.col("m") / block_rows))
    home = home.select("fp", F.pmod(F.xxhash64("gram", salt), F.lit(blocks)).cast("int").alias("block"))
    left = materialize(rows.join(home, "fp"), "left")
    asks = left.groupBy("gram", "block").agg(F.collect_list(F.struct("n", "start", "shares", "comp")).alias("asks"))
    wanted = lambda x: (x["comp"] != F.col("comp")) & feasible(x["n"], F.col("n"), x["start"], F.col("start"), x["shares"], F.col("shares"))
    right = placed.join(asks, "gram").where(F.exists("asks", wanted)).select(F.col("block").alias("to"), "gram", "fp", "n", "comp", F.pmod(F.xxhash64("fp"), F.lit(parts)).cast("int").alias("piece"))
    left = left.select("block", "gram", "fp", "n", "comp", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))

    def product(mine, theirs):
        import pyarrow as pa

        out = ([], [])
        if mine.num_rows and theirs.num_rows:
            g, f, n, c = (np.asarray(theirs[x]) for x in ("gram", "fp", "n", "comp"))
            rows, at, member = np.unique(f, return_index=True, return_inverse=True)
            size, comp = n[at].astype("int64"), c[at]
            order = np.argsort(g, kind="stable")
            g, member = g[order], member[order]
            mg, mf, mn, mc = (np.asarray(mine[x]) for x in ("gram", "fp", "n", "comp"))
            begin, end = np.searchsorted(g, mg), np.searchsorted(g, mg, side="right")
            by = np.argsort(mf, kind="stable")
            for own in np.split(by, np.flatnonzero(np.diff(mf[by])) + 1):
                met = [member[begin[i] : end[i]] for i in own if end[i] > begin[i]]
                if not met:
                    continue
                overlap = np.bincount(np.concatenate(met), minlength=len(rows))
                k = int(mn[own[0]])
                rest = -(-UNION * np.maximum(size, k) // TIMES) - 1
                ok = (overlap > 0) & (comp != mc[own[0]]) & (overlap + rest >= need(size, k)) & (TIMES * np.minimum(size, k) >= UNION * np.maximum(size, k))
                found = rows[ok]
                out[0].append(np.minimum(found, mf[own[0]]))
                out[1].append(np.maximum(found, mf[own[0]]))
        none = np.zeros(0, dtype="int64")
        return pa.table({"a": np.concatenate([none, *out[0]]), "b": np.concatenate([none, *out[1]])})

    return left.groupBy("block", "part").cogroup(right.groupBy("to", "piece")).applyInArrow(product, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: key, n_shingles, component_id (the least key of its component), n_links.

    n_links counts the verified links found for the row's set; it isn't the number of all its partners.
    """
    spark = docs.sparkSession
    rows = identities(docs, key, text)
    held = spark.sparkContext.broadcast(sketch(rows))  # SLOTS bytes
    ids = rows.where("chunk is null").select(key, "fp", "n")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = materialize(shared_columns(leading(docs, text, held), partitions), "columns")
    held.destroy()

    hubs = shared.where("fp <> hub").where(fits(F.col("n"), F.col("hub_n"), F.col("place"), F.col("hub_place")))
    lead = materialize(shared.groupBy("fp").agg(F.max("n").alias("n"), F.min("place").alias("start"), F.collect_set("gram").alias("grams")), "lead")
    first = hubs.select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()
    first = materialize(worth_a_product(first, lead), "pairs")
    links = materialize(verified(first, pair_sets(docs, ids, first, key, text)), "links")
    joined = connected_components(links, "a", "b")

    # columns that still meet several components
    comp = materialize(joined, "comp")
    of = lambda df, name, out: df.join(comp.select(F.col("node").alias(name), F.col("root").alias(out)), name, "left").withColumn(out, F.coalesce(out, name))
    placed = of(of(shared.join(lead.select("fp", "start", F.size("grams").alias("shares")), "fp"), "fp", "comp"), "hub", "hub_comp")
    placed = materialize(placed.select("gram", "fp", "n", "start", "shares", "comp", "hub_comp"), "placed")
    second = materialize(crossing_pairs(placed), "pairs")
    more = materialize(verified(second, pair_sets(docs, ids, second, key, text)), "links")
    if more.count():
        # only the components that met are united
        named = F.coalesce("root", "node")
        ends = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(comp, "node", "left").select("node", named.alias("root"))
        ends = materialize(ends, "ends")
        met = more.join(ends.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(ends.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        united = connected_components(met, "ra", "rb").select(F.col("node").alias("root"), F.col("root").alias("last"))
        every = comp.unionByName(ends.join(comp, "node", "left_anti"))
        comp = materialize(every.join(united, "root", "left").select("node", F.coalesce("last", "root").alias("root")), "comp")

    least = ids.where("fp is not null").groupBy("fp").agg(F.min(key).alias("least"))
    by_set = least.join(comp, least["fp"] == comp["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    by_set = materialize(by_set, "bysets")
    roots = by_set.groupBy("root").agg(F.min("least").alias("component_id"))
    both = links.unionByName(more)
    degree = both.select(F.col("a").alias("fp")).unionByName(both.select(F.col("b").alias("fp"))).groupBy("fp").agg(F.count("*").alias("n_links"))
    named_sets = by_set.join(roots, "root").join(degree, "fp", "left").select("fp", "component_id", "n_links")
    return ids.join(named_sets, "fp", "left").select(
        key, F.col("n").alias("n_shingles"), F.coalesce("component_id", key).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )
