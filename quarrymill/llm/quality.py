"""Operator 2: quality by random-indexing word vectors and a small calibrated network.

Tokens (runs of word characters, runs of other signs; case kept) hash to a fixed number of buckets. Each bucket owns a
sparse ternary index vector; its word vector is the sum of the index vectors of the tokens within two places, over
every text of the corpus. Counts are whole numbers, so the sum doesn't depend on partitions. A document is pooled to
the mean and the deviation of its tokens' vectors. A two-layer network in numpy is fitted on a bounded sample of
labelled rows and its logit divided by a temperature chosen on rows it wasn't fitted on.

Everything that goes to the driver or to all executors is bounded: buckets x dims counts, train_rows pooled rows.

Defined cases: null texts count as empty and pool to zeros. Labels that aren't 0 or 1 are not learnt from; without
labels of both classes the score is the share of positives (0.5 if none). Null ids, ties, repeated rows: each row
is scored by itself. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TOKEN, Hashed, materialize

BUCKETS, DIMS, WINDOW, NONZERO = 8192, 32, 2, 4


def index_vectors(seed: int = 5) -> np.ndarray:
    """buckets + 1 sparse ternary rows; the last is zero and stands between texts."""
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS + 1, DIMS), dtype="int8")
    for row in out[:-1]:
        row[rng.choice(DIMS, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


def batch_ids(texts, hashed: Hashed) -> tuple[np.ndarray, np.ndarray]:
    """Token buckets of all texts, one after the other, and the tokens in each."""
    flat, sizes = [], []
    for t in texts:
        found = TOKEN.findall(t.as_py() or "")
        flat.extend([hashed[x] for x in found])
        sizes.append(len(found))
    return np.array(flat, dtype="int64"), np.array(sizes, dtype="int64")


def add_contexts(total: np.ndarray, ids: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> None:
    """Add to total (dims x buckets) the index vectors around each token, not across texts."""
    if not len(ids):
        return
    gaps = np.full(len(ids) + WINDOW * (len(sizes) + 1), BUCKETS, dtype="int64")
    at = np.arange(len(ids)) + WINDOW * (1 + np.repeat(np.arange(len(sizes)), sizes))
    gaps[at] = ids
    around = index[gaps]
    context = sum(np.roll(around, s, axis=0).astype("int16") for s in range(-WINDOW, WINDOW + 1) if s)[at]
    for d in range(DIMS):
        total[d] += np.bincount(ids, context[:, d], BUCKETS).astype("int64")


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """buckets x dims word vectors over all texts, each of length 1 (or 0)."""
    schema = "bucket int, " + ", ".join(f"c{d} long" for d in range(DIMS))

    def partial(batches):
        import pyarrow as pa

        hashed, index, total = Hashed(BUCKETS), index_vectors(), np.zeros((DIMS, BUCKETS), dtype="int64")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, sizes = batch_ids(batch.column(0).slice(at, 256), hashed)
                add_contexts(total, ids, sizes, index)
        used = np.flatnonzero(total.any(axis=0))
        cols = [pa.array(used, pa.int32()), *(pa.array(total[d, used], pa.int64()) for d in range(DIMS))]
        yield pa.RecordBatch.from_arrays(cols, ["bucket", *(f"c{d}" for d in range(DIMS))])

    sums = docs.select(text).mapInArrow(partial, schema).groupBy("bucket").agg(*(F.sum(f"c{d}").alias(f"c{d}") for d in range(DIMS)))
    got = sums.toArrow()  # at most BUCKETS rows
    out = np.zeros((BUCKETS, DIMS))
    if got.num_rows:
        out[np.asarray(got["bucket"])] = np.stack([np.asarray(got[f"c{d}"]) for d in range(DIMS)], axis=1)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm == 0, 1, norm)).astype("float32")


def pooled(docs: DataFrame, vectors: np.ndarray, extra: list[str], text: str = "text") -> DataFrame:
    """The columns in extra and features binary (float32: mean, deviation, log of the size) of each row."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in extra) + ", features binary"

    def pool(batches):
        import pyarrow as pa

        hashed = Hashed(BUCKETS)
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                ids, sizes = batch_ids(batch.column(0).slice(at, 256), hashed)
                rows, n = np.repeat(np.arange(len(sizes)), sizes), np.maximum(sizes, 1)[:, None]
                v = vectors[ids]
                mean = np.stack([np.bincount(rows, v[:, d], len(sizes)) for d in range(DIMS)], axis=1) / n
                square = np.stack([np.bincount(rows, v[:, d] * v[:, d], len(sizes)) for d in range(DIMS)], axis=1) / n
                deviation = np.sqrt(np.maximum(square - mean * mean, 0))
                found = np.concatenate([mean, deviation, np.log1p(sizes)[:, None] / 10], axis=1).astype("<f4")
                out.extend(x.tobytes() for x in found)
            cols = [batch.column(i + 1) for i in range(len(extra))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.binary())], [*extra, "features"])

    return docs.select(F.col(text).alias("__text"), *extra).mapInArrow(pool, schema)


@dataclass
class Network:
    """x -> tanh layer -> logit / temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -700, 700)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, batch: int = 128, rate: float = 0.003, decay: float = 1e-4, seed: int = 3) -> Network:
    """Adam on log loss over four fifths of the rows; the temperature from the last fifth."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    width = x.shape[1] if x.ndim == 2 else 2 * DIMS + 1
    if not len(y) or y.min() == y.max():
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    cut = max(1, len(y) * 4 // 5)
    own, rest = order[:cut], order[cut:]
    net = Network(x[own].mean(axis=0), x[own].std(axis=0) + 1e-3, rng.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), float(np.log(share / (1 - share))))
    z = (x - net.shift) / net.scale
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        mixed = rng.permutation(own)
        for at in range(0, len(mixed), batch):
            i = mixed[at : at + batch]
            h = np.tanh(z[i] @ params[0] + params[1])
            g = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3][0], -30, 30))) - y[i]) / len(i)
            back = g[:, None] * params[2] * (1 - h * h)
            grads = [z[i].T @ back + decay * params[0], back.sum(axis=0), h.T @ g + decay * params[2], np.array([g.sum()])]
            step += 1
            for p, q, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (q - m)
                v += 0.001 * (q * q - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if len(rest):
        logit, heats = net.logit(x[rest]), np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, np.where(y[rest] == 1, -logit, logit) / t)) for t in heats]
        net.temperature = float(heats[int(np.argmin(loss))])
    return net


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", train_rows: int = 20_000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score (0 to 1) for each row of docs; learn chooses the rows of labels to fit on."""
    vectors = word_vectors(docs, text)
    features = materialize(pooled(docs, vectors, [key], text), "quality")
    usable = labels.where(learn & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    sample = usable.select(key, F.col(label).cast("int").alias("y")).orderBy(F.xxhash64(key), key, "y").limit(train_rows)
    rows = features.join(F.broadcast(sample), key).select("features", "y").toArrow()  # bounded by train_rows
    pairs = sorted(zip(rows["features"].to_pylist(), rows["y"].to_pylist(), strict=True))
    x = np.array([np.frombuffer(f, dtype="<f4") for f, _ in pairs], dtype="float64")
    net = fit_network(x, np.array([y for _, y in pairs], dtype="float64"))

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            found = np.array([np.frombuffer(f, dtype="<f4") for f in batch.column(1).to_pylist()], dtype="float64").reshape(batch.num_rows, -1)
            got = net.score(found) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], [key, "score"])

    return features.mapInArrow(score, f"`{key}` {dict(docs.dtypes)[key]}, score double")
