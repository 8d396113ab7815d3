"""Operator 10: toxicity by a factorization machine over hashed terms.

Terms of a text are its distinct lower-cased words and their prefixes of five letters (inflected forms meet there),
hashed to BUCKETS buckets. Every bucket has a weight and a factor vector; pairs of terms interact through the factors'
inner products, which a linear score can't express. Every bucket takes part, however rare: a weight leaves zero as soon as
the evidence for it outweighs a sparsity penalty, and factors decay. Pairs are weighted by PAIR / the number of terms, so
that long texts aren't decided by their length. The penalty and the number of epochs are those with the lowest log loss on
rows apart from the fit, which also give a slope and an intercept.

The fit uses at most train_rows labelled rows, those with the smallest hash of their id (a documented bound);
scoring covers every whole text. The task that fits holds four bytes for each term of these rows; the driver holds the model.

Defined cases: null texts count as empty and are scored by the bias alone. Labels other than 0 and 1, and null
ones, are not learnt from; a document with several labels is learnt from with each. With no usable labels, or one
class only, scores are the share of positives (0.5 if there are no labels). Null ids are scored like others. Extra
columns pass through; the score's name is a parameter, so that it can't meet one of theirs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CACHE, WORD, Hashed

BUCKETS = 1 << 18
PAIR = 16.0


class Terms(dict):
    """word -> the buckets of its terms."""

    def __init__(self):
        super().__init__()
        self.hashed = Hashed(BUCKETS)

    def __missing__(self, word: str) -> tuple:
        if len(self) >= CACHE:
            self.clear()
        got = self[word] = (self.hashed["w" + word], self.hashed["p" + word[:5]]) if len(word) >= 5 else (self.hashed["w" + word],)
        return got


def text_terms(text: str, terms: Terms) -> list[int]:
    return sorted({c for w in set(WORD.findall(text.lower())) for c in terms[w]})


def segment_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sums of consecutive runs of rows of values; an empty run sums to zero."""
    out = np.zeros((len(sizes), *values.shape[1:]))
    full = np.flatnonzero(sizes)
    if len(full):
        out[full] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[full], axis=0)
    return out


@dataclass
class Model:
    """bias + sum of w + pair / n * sum over pairs of <v, v>, over the n terms of a row; w and v of unused buckets are 0."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    pair: float = PAIR

    def raw(self, index: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and factor sums of rows that hold sizes[0], sizes[1], ... of the buckets in index."""
        if not len(self.w) or not len(index):
            return np.full(len(sizes), self.bias), np.zeros((len(sizes), self.v.shape[1]))
        v = self.v[index]
        sums = segment_sums(v, sizes)
        squares = segment_sums((v * v).sum(axis=1), sizes)
        pairs = 0.5 * ((sums * sums).sum(axis=1) - squares)
        return self.bias + segment_sums(self.w[index], sizes) + self.pair / np.maximum(sizes, 1) * pairs, sums


def calibration(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that lower the log loss of raw; both are held near 1 and 0 by a weak prior."""
    at = np.array([1.0, 0.0])
    rows = np.stack([raw, np.ones(len(raw))], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -30, 30)))
        slope = rows.T @ (p - labels) + 0.5 * (at - [1.0, 0.0])
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + 0.5 * np.eye(2)
        at = at - np.clip(np.linalg.solve(bend, slope), -0.2, 0.2)
    return max(float(at[0]), 0.1), float(at[1])


def fit(index: np.ndarray, sizes: np.ndarray, labels: np.ndarray, factors: int = 4, epochs: int = 12, steps: int = 32, sparse: tuple[float, ...] = (0.15, 0.3, 0.6), decay: float = 0.03, seed: int = 11) -> Model:
    """The machine with the settings that have the lowest log loss on rows apart from the fit, calibrated on such rows.

    Row i holds the next sizes[i] buckets of index, each once. Seven tenths of the rows are fitted, the rest chooses among the
    penalties (sparse, times the root of the number of rows, as chance grows) and the epochs, and gives the calibration;
    then all rows are fitted with these settings. Under 100 rows, all of them do everything.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    bias = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return Model(bias, np.zeros(0), np.zeros((0, factors)))
    buckets, index = np.unique(index, return_inverse=True)  # only these have a weight
    starts = np.cumsum(sizes) - sizes
    rows_of = lambda some: np.concatenate([np.zeros(0, dtype="int64"), *(index[starts[i] : starts[i] + sizes[i]] for i in some)])
    mixed = np.random.default_rng(seed).permutation(len(labels))
    learn, apart = np.split(mixed, [len(mixed) * 7 // 10]) if len(mixed) >= 100 else (mixed, mixed)
    fresh = lambda: Model(bias, np.zeros(len(buckets)), np.random.default_rng(seed).normal(0, 0.05, (len(buckets), factors)))
    run = lambda rows, weight, most: _epochs(fresh(), rows_of, sizes, labels, rows, min(128, max(8, len(rows) // steps)), weight * len(rows) ** 0.5, decay, most, seed)
    held, y, best = rows_of(apart), labels[apart], (np.inf,)
    for weight in sparse:
        worse = 0
        for epoch, m in enumerate(run(learn, weight, epochs), 1):
            raw = m.raw(held, sizes[apart])[0]
            loss = float(np.mean(np.logaddexp(0, raw) - y * raw))
            best, worse = ((loss, weight, epoch, raw), 0) if loss < best[0] - 1e-9 else (best, worse + 1)
            if worse == 3:
                break
    a, b = calibration(best[3], y)
    *_, m = run(mixed, best[1], best[2])
    w, v = np.zeros(BUCKETS, dtype="float32"), np.zeros((BUCKETS, factors), dtype="float32")
    w[buckets], v[buckets] = a * m.w, m.v
    return Model(a * m.bias + b, w, v, a * m.pair)


def _epochs(m: Model, rows_of, sizes: np.ndarray, labels: np.ndarray, learn: np.ndarray, batch: int, sparse: float, decay: float, epochs: int, seed: int, rate: float = 0.05, alpha: float = 0.5):
    """Fits m in place and yields it after each epoch.

    Weights follow the regularised leader (McMahan et al. 2013): a weight leaves zero once the gradients of its bucket
    add up to more than `sparse`, however rare the bucket is, so chance words keep none. Factors take adaptive steps and decay.
    """
    rng, factors = np.random.default_rng(seed), m.v.shape[1]
    total, squares, gv, gb = np.zeros(len(m.w)), np.zeros(len(m.w)), np.full(m.v.shape, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(learn)
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            size, idx = sizes[own], rows_of(own)
            raw, sums = m.raw(idx, size)
            g = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[own]
            gb += g.sum() ** 2
            m.bias -= 0.1 * g.sum() / np.sqrt(gb)
            if not len(idx):
                continue
            r = np.repeat(np.arange(len(own)), size)
            used, place = np.unique(idx, return_inverse=True)  # only the buckets of this batch move
            w, v = m.w[used], m.v[used]
            dw = np.bincount(place, g[r], len(used))
            after = squares[used] + dw * dw
            total[used] += dw - (np.sqrt(after) - np.sqrt(squares[used])) / alpha * w
            squares[used] = after
            z = total[used]
            m.w[used] = np.where(np.abs(z) <= sparse, 0, (np.sign(z) * sparse - z) / ((1 + np.sqrt(after)) / alpha + 1))
            pull = g * m.pair / np.maximum(size, 1)
            inner = pull[:, None] * sums
            own_pull = np.bincount(place, pull[r], len(used))
            dv = np.stack([np.bincount(place, inner[r, f], len(used)) for f in range(factors)], axis=1) - own_pull[:, None] * v + decay * len(own) * v
            gv[used] += dv * dv
            m.v[used] = v - rate * dv / np.sqrt(gv[used])
        yield m


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", train_rows: int = 20_000, key: str = "doc_id", text: str = "text", **options) -> Model:
    """Fit on the bounded sample of labels for which learn holds."""
    usable = labels.where(learn & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    sample = usable.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("k"), "k", "y").limit(train_rows)

    def terms(batches):
        import pyarrow as pa

        known = Terms()
        for batch in batches:
            found = [np.array(text_terms(t.as_py() or "", known), dtype="int32") for t in batch.column(0)]
            ends = np.cumsum([0, *map(len, found)]).astype("int32")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, dtype="int32"), *found])))
            yield pa.RecordBatch.from_arrays([lists, *(batch.column(i) for i in (1, 2, 3))], ["terms", "y", "a", "b"])

    def learnt(batches):
        import pyarrow as pa

        lists, numbers = [], []
        for batch in batches:
            sizes = np.asarray(batch.column(0).value_lengths(), dtype="int64")
            lists += np.split(np.asarray(batch.column(0).flatten()), np.cumsum(sizes)[:-1]) if len(sizes) else []
            numbers.append(np.stack([np.asarray(batch.column(i), dtype="int64") for i in (1, 2, 3)]))
        y, a, b = np.concatenate([np.zeros((3, 0), dtype="int64"), *numbers], axis=1)
        order = np.lexsort((y, b, a))  # not by arrival
        index = np.concatenate([np.zeros(0, dtype="int32"), *(lists[i] for i in order)])
        m = fit(index, np.array([len(lists[i]) for i in order], dtype="int64"), y[order].astype("float64"), **options)
        one = [pa.array([m.bias]), pa.array([m.pair]), pa.array([m.w.astype("<f4").tobytes()], pa.binary()), pa.array([m.v.astype("<f4").tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(one, ["bias", "pair", "w", "v"])

    # at most train_rows rows of two numbers: a bounded side
    chosen = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(sample), "k")
    rows = chosen.select("t", "y", F.xxhash64("k").alias("a"), F.xxhash64("t").alias("b")).mapInArrow(terms, "terms array<int>, y int, a long, b long")
    # the bounded sample is fitted in one task, so that the driver only gets the model
    got = rows.repartition(1).mapInArrow(learnt, "bias double, pair double, w binary, v binary").collect()
    if not got:
        return fit(np.zeros(0, dtype="int32"), np.zeros(0, dtype="int64"), np.zeros(0), **options)
    w = np.frombuffer(got[0]["w"], dtype="<f4")
    v = np.frombuffer(got[0]["v"], dtype="<f4")
    return Model(got[0]["bias"], w, v.reshape(len(w), -1) if len(w) else np.zeros((0, 1)), got[0]["pair"])


def score_texts(docs: DataFrame, model: Model, extra: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """The columns in extra and the score (double) for each row of docs."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in extra) + f", `{out}` double"

    def score(batches):
        import pyarrow as pa

        terms = Terms()
        for batch in batches:
            got = []
            for at in range(0, batch.num_rows, 512):  # bounds the gathered factors
                found = [text_terms(t.as_py() or "", terms) for t in batch.column(0).slice(at, 512)]
                raw, _ = model.raw(np.array([c for f in found for c in f], dtype="int64"), np.array([len(f) for f in found], dtype="int64"))
                got.append(1 / (1 + np.exp(-np.clip(raw, -700, 700))))
            yield pa.RecordBatch.from_arrays([*(batch.column(i + 1) for i in range(len(extra))), pa.array(np.concatenate([np.zeros(0), *got]))], [*extra, out])

    return docs.select(F.col(text).alias("__text"), *[F.col(f"`{c}`") for c in extra]).mapInArrow(score, schema)
