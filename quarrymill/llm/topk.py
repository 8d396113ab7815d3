"""Operator 9: exact top-k by inner product, by MaxScore over shards.

Each dimension is a term, a component its weight. Within a shard a query orders its terms by their score bound
(the most that any row of the shard can gain from the term). Terms whose bounds together can't lift a row to the
threshold are non-essential: the postings of the others are traversed for every row, and the non-essential ones
are probed in steps, only for rows that still can reach the threshold. Shards then merge.

Queries meet candidates in blocks: query_rows queries by shard_rows candidates at a time, each pair of blocks in one
task, so memory is bounded by the two parameters. Results are exact.

Defined cases: null ids and vectors that are null or hold a null or non-finite component take no part. Shorter
vectors count as padded with zeros. Ties go to the smaller id. A row's own id is never its answer, so copies of an
id don't answer each other; several query rows of one id are answered once. Scores beyond 64 bits are held at the
limit. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONG = 2**63 - 1


def usable(vector: Column) -> Column:
    return vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )


def to_matrix(column, width: int):
    """Rows of a list column as whole numbers floor(1024 * x), padded with zeros to width."""
    import numpy as np

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    flat = np.floor(1024 * np.asarray(column.flatten(), dtype="float64"))
    sizes = np.asarray(column.value_lengths().fill_null(0), dtype="int64")
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def maxscore(shard, ids, query, own: int, k: int, steps: int = 8):
    """(scores, ids) of the query's k best rows of a shard, best first, ties to the smaller id."""
    import numpy as np

    keep = ids != own
    if not keep.all():
        shard, ids = shard[keep], ids[keep]
    if not len(ids):
        return np.zeros(0), ids
    bound = np.maximum(query * shard.max(axis=0), query * shard.min(axis=0))
    order = np.argsort(-bound, kind="stable")
    rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])  # what the terms from i on can add
    seed = shard[: max(4 * k, 256)] @ query
    floor = np.partition(seed, len(seed) - k)[len(seed) - k] if len(seed) > k else -math.inf
    essential = int(np.argmax(rest < floor)) if (rest < floor).any() else len(order)
    at, score = essential, shard[:, order[:essential]] @ query[order[:essential]]
    live = np.arange(len(ids))
    while at < len(order):
        alive = score + rest[at] >= floor
        live, score = live[alive], score[alive]
        terms = order[at : at + steps]
        score = score + shard[np.ix_(live, terms)] @ query[terms]
        at += len(terms)
    alive = score >= floor
    live, score = live[alive], score[alive]
    best = np.lexsort((ids[live], -score))[:k]
    return score[best], ids[live][best]



def exact_topk(
    rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
    shard_rows: int = 16384, query_rows: int = 2048, shards_at_least: int = 48,
) -> DataFrame:
    """query_id, rank (from 1), key, score for each row that is_query marks."""
    good = rows.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
    )
    size = good.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("d"), F.count_if("q").alias("q")).first()
    width, shards = size["d"], max(shards_at_least, math.ceil(size["n"] / shard_rows))
    blocks = max(1, math.ceil(size["q"] / query_rows))
    cells = F.array(*[F.lit(i) for i in range(blocks)]) if blocks <= 64 else F.sequence(F.lit(0), F.lit(blocks - 1))
    docs = good.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.explode(cells).alias("block"))
    queries = good.where("q").select(
        "id", "v", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )

    def cell(queries, docs):
        import numpy as np
        import pyarrow as pa

        found = ([], [], [])
        if queries.num_rows and docs.num_rows:
            matrix, ids = to_matrix(docs["v"], width), np.asarray(docs["id"])
            asked, own = to_matrix(queries["v"], width), np.asarray(queries["id"])
            own, first = np.unique(own, return_index=True)
            asked = asked[first]
            if np.abs(matrix).max(initial=0) * np.abs(asked).max(initial=0) * max(width, 1) >= 2**53:
                matrix, asked = matrix.astype(object), asked.astype(object)
                matrix, asked = np.vectorize(int, otypes=[object])(matrix), np.vectorize(int, otypes=[object])(asked)
            for query, who in zip(asked, own, strict=True):
                if matrix.dtype == object:
                    keep = ids != who
                    pairs = sorted(zip([-x for x in matrix[keep] @ query], ids[keep].tolist(), strict=True))[:k]
                    score, best = [-p[0] for p in pairs], [p[1] for p in pairs]
                else:
                    score, best = maxscore(matrix, ids, query, who, k)
                found[0].extend([int(who)] * len(best))
                found[1].extend(int(x) for x in best)
                found[2].extend(min(LONG, max(-LONG, int(x))) for x in score)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), key: pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.int64())})

    best = queries.groupBy("block", "shard").cogroup(docs.groupBy("block", "shard")).applyInArrow(
        cell, f"query_id long, {key} long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", key, "score")
