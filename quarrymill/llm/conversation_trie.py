"""Operator 11: the prefix trie of conversations, with what sharing each prefix saves.

Turns become 64-bit ids of role and text (a collision could only join two children of one node). A conversation is a
row of a matrix, a turn's id in each column, padded. Rows are range-sharded by their sequences and then their key,
so each node is a run of rows. Inside a shard numpy sorts the matrix (lexsort), OR-accumulates where a row differs
from the one before it along the columns, which marks where nodes start, and aggregates the runs of every depth with
reduceat. Wide matrices are worked on in blocks of WIDTH columns over the rows that reach them.

Every measure is a sum or minimum over the rows of a node, given how many turns each row shares with the row before
it. So only nodes on the path of a shard's first or last row can be incomplete. Their parts are written with a hash
of the prefix as key, summed up, and corrected by what a shard couldn't know: the turns that its first row shares
with the last row of the shard before. Nodes below an incomplete one get their parent's key by a join.

Texts never move: turns are hashed where they are read. A task holds one shard (TURNS turns on average, by counting)
and a conversation's ids, 16 bytes a turn. SHA-256 can't be split, so the ids of one incomplete node are read by one
task, in order and chunk by chunk, in constant memory.

Defined cases: a null key is no conversation; null roles and texts are empty; turns of equal number follow the order
of their ids; null turns come first; repeated rows are turns of their own. Other columns are ignored. An empty table
gives no rows. A conversation without turns ends at the root.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .components import sized_join

TURNS, WIDTH = 1_000_000, 64
PAD = np.iinfo(np.int64).min
MEASURES = ["depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
#: A node, or a part of one (with its key, its shard and the keys that end there), or a shard's edge: its outer paths.
ROW = f"conv_id long, {', '.join(f'{c} long' for c in MEASURES)}, ends_sha256 string, key string, parent string, shard int, ends string, first array<string>, sums array<long>, last array<string>"


def sequences(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turns (id and text size of each turn, in order): one row for each conversation."""
    said = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text)]
    ids = F.greatest(F.xxhash64(*said), F.lit(int(PAD) + 1))
    rows = turns.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("conv"), F.struct(F.col(f"`{turn}`").alias("turn"), ids.alias("id"), F.length(said[1]).cast("long").alias("size")).alias("t"))
    return rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t")).select("conv", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["size"].alias("size"))).alias("turns"))


def with_shared_openings(convs: DataFrame, group: int, heads: Column, most: int) -> DataFrame:
    """Each conversation with its first turns taken from the first one of its group of keys; heads (at most `most`) says how many."""
    base = convs.where(F.col("conv") % group == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, most).alias("head"))
    own = convs.select("conv", "turns", (F.col("conv") - F.col("conv") % group).alias("base"), heads.alias("h"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(base, "base", "left").select("conv", F.concat(head, rest).alias("turns"))  # a base meets under `group` rows


def _prefix_keys(ids: np.ndarray) -> list[str]:
    """A key for each prefix, the empty one first."""
    keys, state = ["root"], b""
    for i in ids.tolist():
        state = hashlib.blake2b(state + i.to_bytes(8, "little", signed=True), digest_size=16).digest()
        keys.append(state.hex())
    return keys


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def _block(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: int, width: int) -> np.ndarray:
    """Columns at .. at + width of the padded matrix, for the rows given."""
    column = np.arange(at, at + width)
    inside = column < sizes[:, None]
    return np.where(inside, flat[np.where(inside, starts[:, None] + column, 0)], PAD)


def sort_rows(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, convs: np.ndarray) -> np.ndarray:
    """The order of rows by sequence, then key: stable sorts from the last block of columns to the first."""
    order = np.argsort(convs, kind="stable")
    widest = int(sizes.max(initial=0))
    for at in range((widest - 1) // WIDTH * WIDTH, -1, -WIDTH) if widest else ():
        reach = sizes[order] > at
        some = order[reach]
        m = _block(flat, starts[some], sizes[some], at, min(WIDTH, widest - at))
        order = np.concatenate([order[~reach], some[np.lexsort(m.T[::-1])]])
    return order


def shared_turns(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For sorted rows, how many turns each shares with the one before it; -1 for the first, as it has none."""
    shared = np.zeros(len(sizes), dtype="int64")
    both = np.minimum(sizes[1:], sizes[:-1])
    live, at = np.arange(1, len(sizes)), 0  # rows without a change so far
    while len(live := live[both[live - 1] > at]):
        width = min(WIDTH, int(both[live - 1].max()) - at)
        differs = _block(flat, starts[live], sizes[live], at, width) != _block(flat, starts[live - 1], sizes[live - 1], at, width)
        differs |= np.arange(at, at + width) >= both[live - 1][:, None]
        changed = np.logical_or.accumulate(differs, axis=1)
        shared[live] += width - changed.sum(axis=1)
        live, at = live[~changed[:, -1]], at + width
    shared[:1] = -1
    return shared


def shard_levels(convs: np.ndarray, flat: np.ndarray, weight: np.ndarray, sizes: np.ndarray):
    """The sorted rows (flat positions, sizes, keys), then each depth's nodes as arrays.

    A depth's nodes: conv, parent (places one depth up) with the keys there, the measures, and where the rows that end
    there lie among the sorted keys.
    """
    starts = np.cumsum(sizes) - sizes
    order = sort_rows(flat, starts, sizes, convs)
    convs, starts, sizes = convs[order], starts[order], sizes[order]
    yield starts, sizes, convs
    shared = shared_turns(flat, starts, sizes)
    total = np.concatenate([[0], np.cumsum(weight)])
    repeated = total[starts + np.maximum(shared, 0)]  # where the turns shared with the row before end, in characters
    leaf = np.append(shared[1:] < sizes[:-1], True).astype("int64")
    live, above, depth, up = np.arange(len(convs)), np.zeros(len(convs), dtype="int64"), 0, np.zeros(0, dtype="int64")
    while len(live):
        at = np.flatnonzero(shared[live] < depth)
        count = np.diff(np.append(at, len(live)))
        deeper = sizes[live] > depth
        saved = np.where(shared[live] >= max(depth, 1), repeated[live] - total[starts[live] + max(depth - 1, 0)], 0)
        least = np.minimum.reduceat(convs[live], at)
        ended = np.add.reduceat((~deeper).astype("int64"), at)
        parent = above[live[at]]
        yield {
            "conv": least, "parent": parent, "parent_conv": up[parent] if depth else None, "n_convs": count,
            "n_children": np.add.reduceat((deeper & (shared[live] <= depth)).astype("int64"), at),
            "n_leaves": np.add.reduceat(leaf[live], at), "saved_tokens": np.add.reduceat(saved, at), "from": live[at], "ended": ended,
        }
        above[live] = np.repeat(np.arange(len(at)), count)
        up = least
        live = live[deeper]
        depth += 1


def _shard_rows(batches):
    """One task's shard: finished nodes, parts of the nodes on the paths of its first and last row, and its edge."""
    import pyarrow as pa

    held = [b for b in batches if b.num_rows]
    if not held:
        return
    shard = held[0].column(0)[0].as_py()
    lists = [b.column(2) for b in held]
    part = lambda name: np.concatenate([np.asarray(x.flatten().field(name)) for x in lists]).astype("int64")
    flat, weight = part("id"), part("size")
    counts = np.concatenate([np.asarray(x.value_lengths()) for x in lists]).astype("int64")
    levels = shard_levels(np.concatenate([np.asarray(b.column(1)) for b in held]), flat, weight, counts)
    starts, sizes, convs = next(levels)
    path = lambda r: slice(starts[r], starts[r] + sizes[r])
    first, last = _prefix_keys(flat[path(0)]), _prefix_keys(flat[path(-1)])
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in MEASURES), ("ends_sha256", pa.string()), ("key", pa.string()), ("parent", pa.string()), ("shard", pa.int32()),
                        ("ends", pa.string()), ("first", pa.list_(pa.string())), ("sums", pa.list_(pa.int64())), ("last", pa.list_(pa.string()))])

    def batch(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if columns.get(f.name) is not None else pa.nulls(n, f.type) for f in schema], schema=schema)

    nobody, above = _digest(convs[:0]), {}  # above: keys of the incomplete nodes one depth up, by place
    for depth, x in enumerate(levels):
        n = len(x["conv"])
        open_here = ({0: first[depth]} if depth < len(first) else {}) | ({n - 1: last[depth]} if depth < len(last) else {})
        key, parent, shas, ends = ([None] * n for _ in range(4))
        for place, name in above.items():
            for i in np.flatnonzero(x["parent"] == place).tolist():
                parent[i] = name
        shas = [nobody] * n
        for i in np.flatnonzero(x["ended"]).tolist():
            shas[i] = _digest(convs[x["from"][i] : x["from"][i] + x["ended"][i]])
        for i, name in open_here.items():
            key[i], shas[i] = name, None
            if x["ended"][i]:
                ends[i] = ",".join(map(str, convs[x["from"][i] : x["from"][i] + x["ended"][i]].tolist()))
        measures = {c: x[c] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
        yield batch(n, conv_id=x["conv"], depth=np.full(n, depth), parent_conv_id=x["parent_conv"], **measures, ends_sha256=shas, key=key, parent=parent, shard=np.full(n, shard), ends=ends)
        above = open_here
    sums = np.concatenate([[0], np.cumsum(weight[path(0)])])
    yield batch(1, shard=[shard], first=[first], sums=[sums], last=[last])


def _ends_hashes(batches):
    """sha256 of each key's chunks in the order they come, in constant memory; a key's rows are consecutive."""
    import pyarrow as pa

    now, state = None, None
    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if key != now:
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])
                now, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def _recombined(written: DataFrame) -> DataFrame:
    """The incomplete nodes from all their parts: key, parent, depth, conv_id, the measures, ends_sha256."""
    parts = written.where("key IS NOT NULL")
    before = Window.orderBy("shard")  # one row for each shard
    edges = written.where("first IS NOT NULL").select("first", "sums", F.lag("last").over(before).alias("before")).where("before IS NOT NULL")
    edges = edges.withColumn("shared", F.size(F.array_intersect("first", "before")) - 1)
    # the shard took its first row as new from depth 1 on, and the shard before its last row as a leaf
    fixes = edges.select("*", F.explode(F.sequence(F.lit(0), F.col("shared"))).alias("at")).select(
        F.get("first", F.col("at")).alias("key"), (-(F.col("at") < F.col("shared")).cast("long")).alias("n_children"), (-(F.col("shared") == F.size("before") - 1).cast("long")).alias("n_leaves"),
        (F.get("sums", F.col("shared")) - F.get("sums", F.greatest(F.col("at") - 1, F.lit(0)))).alias("saved_tokens"),
    )
    both = parts.select("key", "parent", "depth", "conv_id", *MEASURES[2:]).unionByName(fixes, allowMissingColumns=True)
    nodes = both.groupBy("key").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in MEASURES[2:]])
    chunks = parts.where("ends IS NOT NULL").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard").select("key", "ends")
    hashes = chunks.mapInArrow(_ends_hashes, "key string, ends_sha256 string")
    return nodes.join(hashes, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))


def trie_nodes(convs: DataFrame) -> DataFrame:
    """The nodes of conversations given as conv (long) and turns (arrays of id and size, in order)."""
    spark = convs.sparkSession
    rows = materialize(convs.select(F.col("conv").cast("long").alias("conv"), "turns"), "rebuilt")
    turns = rows.agg(F.sum(F.size("turns"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // TURNS))
    # the longest common prefix comes first in the order of arrays, so a node's rows are neighbours
    ranged = rows.withColumn("ids", F.col("turns.id")).repartitionByRange(shards, "ids", "conv").select(F.spark_partition_id().alias("shard"), "conv", "turns")
    written = materialize(ranged.mapInArrow(_shard_rows, ROW), "nodes")
    open_nodes = materialize(_recombined(written), "open")
    done = written.where("key IS NULL AND depth IS NOT NULL")
    columns = ["conv_id", *MEASURES, "ends_sha256"]
    near = open_nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("up"))
    under = sized_join(done.where("parent IS NOT NULL").unionByName(open_nodes, allowMissingColumns=True), materialize(near, "parents"), "parent", "left", 16)
    return done.where("parent IS NULL").select(columns).unionByName(under.withColumn("parent_conv_id", F.col("up")).select(columns))


def shared_opening_trie(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """The trie of conversations rebuilt with openings of the first of their hundred, crc32(key) % most turns long."""
    heads = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    return trie_nodes(with_shared_openings(sequences(turns), group, heads, most - 1))
