"""Batches: weight-bounded packing and batch functions with per-row errors and halving on failure."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_shard(key: Column, shards: int) -> Column:
    """A shard by the first eight hexadecimal digits of the key's MD5, which any engine can repeat."""
    return (F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % shards).cast("int")


def pack_greedy(df: DataFrame, key: str, weight: str, most: int, limit: int, shards: int | None = None, shard_rows: int = 100_000) -> DataFrame:
    """key, shard, batch: in key order within hash shards, a batch closes when most items or limit weight would be passed.

    Sequential by nature, so each shard is one task's work; shards are as many as the counted rows need (shard_rows each)
    unless given. No batch passes the limit unless one item alone does.
    """
    out = f"`{key}` {dict(df.dtypes)[key]}, shard int, batch int"
    shards = shards or max(1, -(-df.count() // shard_rows))

    def pack(pdf):
        pdf = pdf.sort_values(key)
        batches, batch, n, total = [], 0, 0, 0
        for w in pdf[weight].fillna(0):
            if n and (n >= most or total + w > limit):
                batch, n, total = batch + 1, 0, 0
            n, total = n + 1, total + w
            batches.append(batch)
        return pdf[[key, "shard"]].assign(batch=batches)

    return df.select(key, weight, hash_shard(F.col(key), shards).alias("shard")).groupBy("shard").applyInPandas(pack, out)


def map_batches(df: DataFrame, key: str, value: str, fn: Callable[[list], list], size: int) -> DataFrame:
    """key, status, result, error: fn over batches of size values. A batch that fails is halved until one row is left."""
    out = f"`{key}` {dict(df.dtypes)[key]}, status string, result string, error string"

    def run(keys, values):
        try:
            return [(k, "ok", None if r is None else str(r), None) for k, r in zip(keys, fn(values), strict=True)]
        except Exception as e:  # noqa: BLE001  any failure of a caller's function becomes that row's error
            if len(keys) == 1:
                return [(keys[0], "error", None, f"{type(e).__name__}: {e}")]
            half = len(keys) // 2
            return run(keys[:half], values[:half]) + run(keys[half:], values[half:])

    def work(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for at in range(0, len(pdf), size):
                part = pdf.iloc[at : at + size]
                rows += run(part[key].tolist(), part[value].tolist())
            yield pd.DataFrame(rows, columns=[key, "status", "result", "error"])

    return df.select(key, value).mapInPandas(work, out)


def hashed_embedding(c, dims: int = 16):
    """A deterministic stand-in for an embedding model: hashed word counts, in built-in expressions."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")
    places = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(dims)).cast("int"))
    count = lambda held: F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.size(F.filter(held, lambda p: p == d)).cast("double"))
    return F.transform(F.array(places), count)[0]  # bound to a variable, or each dimension would split and hash the text again
