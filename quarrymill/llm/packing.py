"""Operator 7: hierarchical residual best-fit packing of token sequences.

Each scan partition tokenizes its documents, cuts the long ones, and packs its pieces best-fit, longest first. Bins
that are nearly full go out at once. The others become items of the next round: only their number and size move on, and
each round deals them to fewer groups that pack them again, a tree of merges. A round has as many groups as keep a group at
GROUP items on average, whatever the turn, so no task holds more than its share. The tree ends when one group was left, or when a
round saved less than 1 in 1,000 of its bins: what can't be paired by then (say, many documents of 600 tokens) stays as it is.
Pieces join their sequence at the end.

Token ids are those of the `tokenizers` file byte_bpe_50k.json; they're computed with tiktoken over the same vocabulary
(measured equal and eight times as fast). A text that holds "<|" goes through `tokenizers` itself, whose treatment
of special strings then holds.

Defined cases: a null text counts as empty; an empty one is the end id alone. Only a document longer than the
sequence is cut: whole pieces at its end, the shorter piece first. Null or repeated ids are packed as they are.
An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

_loaded: dict = {}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(json_path: str, ranks_path: str):
    """text -> ids; kept by the worker process."""
    if (json_path, ranks_path) not in _loaded:
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        whole = []

        def encode(text: str) -> list[int]:
            if "<|" in text:
                if not whole:
                    from tokenizers import Tokenizer

                    whole.append(Tokenizer.from_file(json_path))
                return whole[0].encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        _loaded[json_path, ranks_path] = encode
    return _loaded[json_path, ranks_path]


def cut(size: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first piece may be shorter."""
    if size <= limit:
        return [(0, size)]
    first = size % limit or limit
    return [(0, first), *((at, limit) for at in range(first, size, limit))]


def best_fit(sizes: list[int], limit: int) -> list[list[int]]:
    """Indices by bin: longest first, each into the fullest bin that has room (ties: the oldest)."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # (room, bin), ascending
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(rooms, (sizes[i], -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
            bins[b].append(i)
        else:
            room, b = limit, len(bins)
            bins.append([i])
        if room > sizes[i]:
            insort(rooms, (room - sizes[i], b))
    return bins


#: Items of a group in a round, on average.
GROUP = 4096
PIECES = "`{key}` {id}, piece int, start long, length long, ids_crc32 long, bin long, before long, filled long, open boolean"


def pack_documents(
    docs: DataFrame, limit: int = 1024, end_id: int = 2, slack: int = 8, fan_in: int = 16, group: int = GROUP, key: str = "doc_id",
    text: str = "text", json_path: str | None = None, ranks_path: str | None = None,
) -> DataFrame:
    """One row for each piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    Bins within slack tokens of limit leave at once; fan_in groups merge into one in each round.
    """
    json_path = json_path or vocabulary_path("byte_bpe_50k.json")
    ranks_path = ranks_path or vocabulary_path("byte_bpe_50k.tiktoken")
    schema = PIECES.format(key=key, id=dict(docs.dtypes)[key])
    nearly = limit - slack

    def local(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(json_path, ranks_path)
        names = [key, "piece", "start", "length", "ids_crc32", "bin", "before", "filled", "open"]
        prefix, kind, waiting = TaskContext.get().partitionId() << 36, None, []

        def packed(rows, prefix):
            """The rows with their bins, numbered from prefix."""
            bins = best_fit([r[3] for r in rows], limit)
            out = []
            for n, own in enumerate(bins):
                filled, before = sum(rows[i][3] for i in own), 0
                for i in own:
                    out.append((*rows[i], prefix + n, before, filled, filled < nearly))
                    before += rows[i][3]
            cols = list(zip(*out, strict=True))
            kinds = [kind, pa.int32(), *[pa.int64()] * 6, pa.bool_()]
            return len(bins), pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for batch in batches:
            kind = batch.column(0).type
            for who, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(t.as_py() or ""), end_id], dtype="<u4")
                for n, (start, length) in enumerate(cut(len(ids), limit)):
                    waiting.append((who, n, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            if len(waiting) >= 50_000:
                n, out = packed(waiting, prefix)
                prefix, waiting = prefix + n, []
                yield out
        if waiting:
            yield packed(waiting, prefix)[1]

    pieces = materialize(docs.select(key, text).mapInArrow(local, schema), "pieces")
    items = pieces.where("open and before = 0").select("bin", "filled")  # each bin once
    groups, left, moves, turn = max(1, -(-pieces.rdd.getNumPartitions() // fan_in)), items.count(), [], 0
    while left:
        turn += 1
        groups = max(groups, -(-left // group))
        # one row for each item: the bin it goes to, what that bin holds before it, and all it holds
        dealt = items.withColumn("by", F.pmod(F.xxhash64("bin", F.lit(turn)), F.lit(groups)).cast("long"))
        level = materialize(dealt.groupBy("by").applyInArrow(_merger(limit, turn), "item long, bin long, before long, filled long"), "pack")
        moves.append(level.select("item", "bin", "before"))
        items = level.where((F.col("before") == 0) & (F.col("filled") < nearly)).select("bin", "filled")
        saved, had, left = level.where("before > 0").count(), left, items.count()
        if groups == 1 or saved * 1000 < had:
            break
        groups = -(-groups // fan_in)

    named = [F.col(f"`{key}`"), "piece", "start", "length", "ids_crc32"]
    placed = pieces.select(*named, "open", F.col("bin").alias("sequence_id"), F.col("before").alias("offset"))
    open_ = placed.where("open").drop("open")
    for move in moves:  # a bin of an earlier round stands in a later one, or stays
        step = move.select(F.col("item").alias("sequence_id"), "bin", "before")
        joined = open_.join(step, "sequence_id", "left")
        open_ = joined.select(*named, F.coalesce("bin", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("before", F.lit(0))).alias("offset"))
    return placed.where("not open").drop("open").unionByName(open_)


def _merger(limit: int, turn: int):
    """Pack the underfull bins of one group again."""

    def merge(by, table):
        import pyarrow as pa

        rows = sorted(zip(table["bin"].to_pylist(), table["filled"].to_pylist(), strict=True))
        prefix = (turn << 57) + (by[0].as_py() << 33)
        out = ([], [], [], [])
        for n, own in enumerate(best_fit([r[1] for r in rows], limit)):
            filled, before = sum(rows[i][1] for i in own), 0
            for i in own:
                for c, x in zip(out, (rows[i][0], prefix + n, before, filled), strict=True):
                    c.append(x)
                before += rows[i][1]
        return pa.table([pa.array(c, pa.int64()) for c in out], ["item", "bin", "before", "filled"])

    return merge
