"""Vectors: checks, the exact neighbour graph by blocks, fuzzy weights, layouts and regions with names."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.logs import write_verified


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def vector_stats(df: DataFrame, vector: str) -> DataFrame:
    """n_rows, n_bad (null, or with a component that isn't finite), norm_min, norm_max."""
    bad = F.col(vector).isNull() | F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    size = F.when(~bad, norm(F.col(vector)))
    return df.agg(F.count("*").alias("n_rows"), F.count_if(bad).alias("n_bad"), F.round(F.min(size), 6).alias("norm_min"), F.round(F.max(size), 6).alias("norm_max"))


def _nearest(x, x_ids, y, y_ids, k: int, same: bool, rows: int = 256, first: int = 2048):
    """(row of x, place in y, distance) of the k nearest in y for each row of x, by distance and id; x and y are unit vectors.

    Products in single precision choose candidates: all whose product isn't below the k-th best so far by more than the
    rounding error. Their distances are computed in double precision, so the result is exact. The bound is renewed each
    time the columns seen have doubled. same: x and y may share ids; a row is no neighbour of its own id.
    """
    import numpy as np

    slack = 2 * (x.shape[1] + 4) * 2.0**-23
    xf, yf = x.astype("float32"), y.astype("float32")
    found = []
    for at in range(0, len(x), rows):
        part, n = xf[at : at + rows], min(rows, len(x) - at)
        who, where, far = np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0)
        floor, begin, size = np.full(n, -np.inf, "float32"), 0, first
        while begin < len(y):
            new = []
            for c in range(begin, min(begin + size, len(y)), first):
                s = part @ yf[c : min(c + first, begin + size)].T
                if same:
                    s[x_ids[at : at + n, None] == y_ids[None, c : c + s.shape[1]]] = -np.inf
                if c == 0 and s.shape[1] > k:
                    floor = np.partition(s, -k, axis=1)[:, -k] - np.float32(slack)
                r, j = np.nonzero((s >= floor[:, None]) & (s > -np.inf))
                new.append((r, j + c))
            r, j = (np.concatenate(z) for z in zip(*new, strict=True))
            d = np.empty(len(r))
            for p in range(0, len(r), 65536):
                d[p : p + 65536] = 1 - np.einsum("ij,ij->i", x[at + r[p : p + 65536]], y[j[p : p + 65536]])
            who, where, far = np.concatenate([who, r]), np.concatenate([where, j]), np.concatenate([far, d])
            order = np.lexsort((y_ids[where], far, who))
            who, where, far = who[order], where[order], far[order]
            place = np.arange(len(who)) - np.searchsorted(who, who)
            kept = (place < k) & np.isfinite(far)
            full = who[kept & (place == k - 1)]
            floor[full] = (1 - far[kept & (place == k - 1)] - slack).astype("float32")
            who, where, far = who[kept], where[kept], far[kept]
            begin, size = begin + size, max(first, begin + size)
        found.append((who + at, where, far))
    return tuple(np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0))


def knn(df: DataFrame, key: str, vector: str, k: int, block_rows: int = 32768, blocks_at_least: int = 4) -> DataFrame:
    """key, rank, neighbour, distance (1 - cosine): the k nearest other rows, exact, ties to the smaller key.

    Every block of rows meets every block in a task of its own, which keeps k rows for each, as one row; the blocks then
    merge. A task holds two blocks. The work is a product of all rows by all rows, so it grows with their square.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(norm(F.col(vector)) > 0)
    blocks = max(blocks_at_least, math.ceil(rows.count() / block_rows))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left, right = rows.select("id", "v", own.alias("i"), every.alias("j")), rows.select("id", "v", own.alias("j"), every.alias("i"))

    def nearest(a, b):
        import numpy as np
        import pyarrow as pa

        def unit(t):
            v = t["v"].combine_chunks()
            m = v.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(v), -1)
            with np.errstate(invalid="ignore"):
                m = m / np.linalg.norm(m, axis=1, keepdims=True)
            finite = np.isfinite(m).all(axis=1)
            return m[finite], t["id"].to_numpy().astype("int64")[finite]

        empty = pa.table({"id": pa.array([], pa.int64()), "best": pa.array([], pa.list_(pa.struct([("distance", pa.float64()), ("neighbour", pa.int64())])))})
        if not len(a) or not len(b):
            return empty
        (x, x_ids), (y, y_ids) = unit(a), unit(b)
        who, where, far = _nearest(x, x_ids, y, y_ids, k, a["i"][0] == a["j"][0])
        if not len(who):
            return empty
        ends = np.searchsorted(who, np.unique(who), side="right")
        starts = np.concatenate([[0], ends]).astype("int32")
        best = pa.StructArray.from_arrays([pa.array(far), pa.array(y_ids[where])], ["distance", "neighbour"])
        return pa.table({"id": x_ids[who[ends - 1]], "best": pa.ListArray.from_arrays(pa.array(starts), best)})

    tiles = blocks * blocks  # a given number: Spark would merge tasks by their bytes, which are few beside their work
    left, right = left.repartition(tiles, "i", "j"), right.repartition(tiles, "i", "j")
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(nearest, "id long, best array<struct<distance:double,neighbour:long>>")
    merged = found.groupBy("id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    ranked = merged.select("id", F.posexplode("best").alias("at", "b"))
    return ranked.select(F.col("id").alias(key), (F.col("at") + 1).alias("rank"), F.col("b.neighbour").alias("neighbour"), F.col("b.distance").alias("distance"))


def fuzzy_graph(neighbours: DataFrame, key: str, steps: int = 64) -> DataFrame:
    """a, b, weight in (0, 1]: neighbour weights exp(-(d - rho) / sigma) (McInnes et al. 2018), united as a + b - ab.

    rho is the nearest distance; sigma is found by bisection so that the weights of a row sum to log2(k). A row's neighbours
    are one list, and the rows of an Arrow batch are searched together.
    """

    def weigh(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            d = batch["distances"]
            n = np.diff(d.offsets.to_numpy())
            there = np.arange(n.max())[None, :] < n[:, None]
            over = np.full(there.shape, np.inf)
            over[there] = d.flatten().to_numpy()
            over = np.maximum(over - over.min(axis=1, keepdims=True), 0)
            want = np.maximum(np.log2(n), 1e-9)
            lo, hi, sigma = np.zeros(len(n)), np.full(len(n), np.inf), np.ones(len(n))
            for _ in range(steps):
                above = np.exp(-over / sigma[:, None]).sum(axis=1) > want
                hi, lo = np.where(above, sigma, hi), np.where(above, lo, sigma)
                sigma = np.where(np.isinf(hi), sigma * 2, (lo + hi) / 2)
            w = np.maximum(np.exp(-over / np.maximum(sigma, 1e-9)[:, None]), 1e-12)
            yield pa.RecordBatch.from_arrays([batch[key], batch["neighbours"], pa.ListArray.from_arrays(d.offsets, pa.array(w[there]))], ["id", "neighbours", "w"])

    lists = neighbours.groupBy(key).agg(F.collect_list(F.struct("neighbour", "distance")).alias("n")).select(key, F.col("n.neighbour").alias("neighbours"), F.col("n.distance").alias("distances"))
    one = lists.mapInArrow(weigh, "id long, neighbours array<long>, w array<double>").select("id", F.explode(F.arrays_zip("neighbours", "w")).alias("e"))
    ends = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    both = one.select(F.explode(F.array(ends("id", "e.neighbours"), ends("e.neighbours", "id"))).alias("ab"), "e.w").select("ab.a", "ab.b", "w")
    # each direction of an edge has one or two weights
    return both.groupBy("a", "b").agg((F.sum("w") - F.when(F.count("*") > 1, F.product("w")).otherwise(0.0)).alias("weight"))


def layout_pca(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key, x, y: the two principal components; the covariance is summed on the executors."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    xy = PCA(k=2, inputCol="features", outputCol="xy").fit(rows).transform(rows)
    return xy.select(key, vector_to_array("xy")[0].alias("x"), vector_to_array("xy")[1].alias("y"))


def layout_spectral(graph: DataFrame, start: DataFrame, key: str, rounds: int = 5, steps: int = 3) -> DataFrame:
    """key, x, y: coordinates from a weighted graph (a, b, weight, both directions), by power iteration from start's (key, x, y).

    The walk is (I + D^-1/2 W D^-1/2) / 2. After every `steps` of it the two columns are made orthogonal to the trivial
    vector (the roots of the degrees) and to each other, so they turn towards the next two, the smoothest ones over the
    graph; x and y are these divided by the roots of the degrees. A step is an aggregate over edges; five sums of a round
    reach the driver, and each round is a table of its own. Nodes without edges keep the origin.
    """
    degree = graph.groupBy(F.col("a").alias(key)).agg(F.sum("weight").alias("d"))
    edges = graph.join(degree.select(F.col(key).alias("a"), F.col("d").alias("da")), "a").join(degree.select(F.col(key).alias("b"), F.col("d").alias("db")), "b")
    edges = write_verified(edges.select("a", "b", (F.col("weight") / F.sqrt(F.col("da") * F.col("db"))).alias("w")), "edges")
    now = degree.join(start.select(key, "x", "y"), key, "left").select(key, F.sqrt("d").alias("t"), (F.coalesce("x", F.lit(0.0)) * F.sqrt("d")).alias("x"), (F.coalesce("y", F.lit(0.0)) * F.sqrt("d")).alias("y"))
    now = write_verified(now, "spectral")
    dot = lambda p, q: F.sum(F.col(p) * F.col(q))
    for turn in range(rounds + 1):
        # orthogonal to the trivial vector, then to each other, of length 1
        g = now.agg(dot("t", "t").alias("tt"), dot("t", "x").alias("tx"), dot("t", "y").alias("ty")).first()
        flat = now.select(key, "t", *[(F.col(c) - F.col("t") * ((g["t" + c] or 0) / (g["tt"] or 1))).alias(c) for c in ("x", "y")])
        h = flat.agg(dot("x", "x").alias("xx"), dot("x", "y").alias("xy"), dot("y", "y").alias("yy")).first()
        xx = h["xx"] or 1.0
        yy = max((h["yy"] or 0) - (h["xy"] or 0) ** 2 / xx, 1e-300)
        flat = flat.select(key, "t", (F.col("x") / math.sqrt(xx)).alias("x"), ((F.col("y") - F.col("x") * ((h["xy"] or 0) / xx)) / math.sqrt(yy)).alias("y"))
        if turn == rounds:
            break
        for _ in range(steps):
            moved = edges.join(flat.select(F.col(key).alias("b"), "x", "y"), "b").groupBy(F.col("a").alias(key)).agg(F.sum(F.col("w") * F.col("x")).alias("mx"), F.sum(F.col("w") * F.col("y")).alias("my"))
            flat = flat.join(moved, key).select(key, "t", ((F.col("x") + F.col("mx")) / 2).alias("x"), ((F.col("y") + F.col("my")) / 2).alias("y"))
        now = write_verified(flat, "spectral")
    found = flat.select(key, (F.col("x") / F.col("t")).alias("x"), (F.col("y") / F.col("t")).alias("y"))
    return start.select(key).join(found, key, "left").select(key, F.coalesce("x", F.lit(0.0)).alias("x"), F.coalesce("y", F.lit(0.0)).alias("y"))


def orient(coords: DataFrame, key: str, share: float = 0.15) -> DataFrame:
    """coords turned a quarter if taller than wide (1 to 99 % spread), then mirrored so that a corner box is emptiest.

    Of the four mirrorings the one with the fewest points in the lower right box wins, ties to fewer flips.
    """
    s = coords.agg(F.percentile("x", F.array(F.lit(0.01), F.lit(0.99))).alias("px"), F.percentile("y", F.array(F.lit(0.01), F.lit(0.99))).alias("py")).first()
    tall = s["px"] is not None and s["py"][1] - s["py"][0] > s["px"][1] - s["px"][0]
    turned = coords.select(key, F.col("y").alias("x"), (-F.col("x")).alias("y")) if tall else coords.select(key, "x", "y")
    e = turned.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    if e["x0"] is None:
        return turned
    left, right = F.col("x") <= e["x0"] + share * (e["x1"] - e["x0"]), F.col("x") >= e["x1"] - share * (e["x1"] - e["x0"])
    low, high = F.col("y") <= e["y0"] + share * (e["y1"] - e["y0"]), F.col("y") >= e["y1"] - share * (e["y1"] - e["y0"])
    corners = [((1, 1), right & low), ((-1, 1), left & low), ((1, -1), right & high), ((-1, -1), left & high)]
    counts = turned.agg(*[F.count_if(c).alias(f"c{i}") for i, (_, c) in enumerate(corners)]).first()
    best = min(range(4), key=lambda i: (counts[i], corners[i][0].count(-1), i))
    fx, fy = corners[best][0]
    return turned.select(key, (F.col("x") * fx).alias("x"), (F.col("y") * fy).alias("y"))


def regions(coords: DataFrame, key: str, cells: list[int], least: int, dense: int = 2) -> DataFrame:
    """key, layer (0 the finest), region (null: outside): connected dense grid cells, one grid for each layer.

    Cells, not points, are joined, so the iterated part stays as small as the grids; all layers iterate together.
    """
    e = coords.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    x0, y0 = e["x0"] or 0, e["y0"] or 0
    wide = max((e["x1"] or 0) - x0, (e["y1"] or 0) - y0, 1e-12)
    layers = F.explode(F.array(*[F.struct(F.lit(i).alias("layer"), F.lit(wide / n).alias("step"), F.lit(n + 1).alias("width")) for i, n in enumerate(cells)]))
    at = coords.select(key, "x", "y", layers.alias("l")).select(
        key, "l.layer", "l.width", F.floor((F.col("x") - x0) / F.col("l.step")).alias("cx"), F.floor((F.col("y") - y0) / F.col("l.step")).alias("cy")
    )
    grid = at.groupBy("layer", "width", "cx", "cy").agg(F.count("*").alias("n")).where(F.col("n") >= dense)
    grid = write_verified(grid.withColumn("cell", F.col("cx") * F.col("width") + F.col("cy")), "grid")
    steps = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    moves = grid.select("layer", "cell", "cx", "cy", steps.alias("d")).select("layer", "cell", (F.col("cx") + F.col("d.a")).alias("cx"), (F.col("cy") + F.col("d.b")).alias("cy"))
    edges = moves.join(grid.select("layer", "cx", "cy", F.col("cell").alias("next")), ["layer", "cx", "cy"]).select("layer", "cell", "next")
    edges = write_verified(edges, "edges")
    named = grid.select("layer", "cell", "cx", "cy", "n", F.col("cell").alias("root"))
    while True:
        near = edges.join(named.select("layer", F.col("cell").alias("next"), "root"), ["layer", "next"]).groupBy("layer", "cell").agg(F.min("root").alias("low"))
        jump = named.select("layer", F.col("cell").alias("low"), F.col("root").alias("low2"))
        after = named.join(near, ["layer", "cell"]).join(jump, ["layer", "low"])
        after = after.select("layer", "cell", "cx", "cy", "n", F.least("root", "low", "low2").alias("root"), (F.least("low", "low2") < F.col("root")).alias("moved"))
        after = write_verified(after, "named")
        named = after.drop("moved")
        if not after.where("moved").limit(1).count():
            break
    sizes = named.groupBy("layer", "root").agg(F.sum("n").alias("size")).where(F.col("size") >= least)
    found = named.join(sizes, ["layer", "root"]).select("layer", "cx", "cy", F.col("root").alias("region"))
    return at.join(found, ["layer", "cx", "cy"], "left").select(key, "layer", "region")


def layer_stats(labels: DataFrame) -> DataFrame:
    """layer, regions, outside (share), median_size."""
    sizes = labels.where("region is not null").groupBy("layer", "region").agg(F.count("*").alias("size")).groupBy("layer").agg(F.count("*").alias("regions"), F.percentile("size", 0.5).alias("median_size"))
    share = labels.groupBy("layer").agg(F.avg(F.col("region").isNull().cast("double")).alias("outside"))
    return share.join(sizes, "layer", "left").select("layer", F.coalesce("regions", F.lit(0)).alias("regions"), F.round("outside", 6).alias("outside"), "median_size")


def region_terms(texts: DataFrame, region: str, text: str, k: int) -> DataFrame:
    """region, place, term, score: class-based TF-IDF, tf * log(1 + A / f) with A the mean words of a region."""
    words = texts.select(region, F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("term")).where("term <> ''")
    tf = words.groupBy(region, "term").agg(F.count("*").alias("tf"))
    f = tf.groupBy("term").agg(F.sum("tf").alias("f"))
    mean = tf.agg((F.sum("tf") / F.count_distinct(region)).alias("a"))
    score = F.col("tf") * F.log(1 + mean.scalar() / F.col("f"))
    ranked = tf.join(f, "term").withColumn("score", F.round(score, 6))
    rank = F.row_number().over(Window.partitionBy(region).orderBy(F.desc("score"), "term"))
    return ranked.withColumn("place", rank).where(F.col("place") <= k).select(region, "place", "term", "score")
