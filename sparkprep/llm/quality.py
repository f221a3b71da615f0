"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata derived from the text.

A document becomes a sparse vector: hashed words (L2-normalised counts),
structure statistics (character classes, repetition, word and line shape) as
values and as quantised indicators, and its length. The machine scores

    w0 + sum_j w_j x_j + 1/2 sum_f ((sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2)

in time linear in the non-zero entries. It is fitted on at most
``max_train`` labelled rows, taken in the order of a hash of their id so that
the sample does not depend on the layout; the fit sees no row that
``held_out`` marks, and never an id, language or source. Every document is
then scored inside its own scan task: no shuffle.

Null and empty texts are scored like any text (all statistics zero). Without
labelled rows of the training folds every score is 0.5. Rows may repeat; each
is scored by itself. Very long texts are read whole, one at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BY_SPACE, Words, bounded_batches, buffers, held_out, slices

WORD_BITS = 13
FACTORS = 8
MAX_TRAIN = 6000
THRESHOLD = 0.7

_STEPS = 12  # indicator bins of a statistic

# byte classes: 0 other letters, 1 A-Z, 2 digits, 3 spaces, 4 line ends,
# 5 sentence marks, 6 other ASCII symbols, 7 non-ASCII
_CLASS = np.full(256, 6, np.uint8)
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[10] = 4
_CLASS[[ord(c) for c in ".,;:?!'\"()-"]] = 5
_CLASS[128:] = 7
_CLASSES = 8

N_STATS = _CLASSES + 7
WIDTH = (1 << WORD_BITS) + N_STATS * (1 + _STEPS)


def _distinct(rows: np.ndarray, hashes: np.ndarray, n_rows: int, bits: int):
    """Sorted (row, low hash bits) keys with their counts."""
    key = (rows.astype(np.uint64) << np.uint64(bits)) | (hashes & np.uint64((1 << bits) - 1))
    key.sort()
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    count = np.diff(np.r_[at, len(key)])
    return (key[at] >> np.uint64(bits)).astype(np.int64), (key[at] & np.uint64((1 << bits) - 1)).astype(np.int64), count


def features(data: np.ndarray, offs: np.ndarray):
    """Sparse rows (bounds, index, value) of a slice of documents."""
    n = len(offs) - 1
    words = Words(data, offs, BY_SPACE)
    size = np.diff(offs)
    row = np.repeat(np.arange(n), size)
    classes = np.bincount(row * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES)
    nw = np.maximum(words.count, 1)
    near = np.zeros(len(words.doc), bool)
    near[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    row48, _, _ = _distinct(words.doc, words.hash, n, 44)
    tri, tri_row = words.shingles(3)
    tri48, _, _ = _distinct(tri_row, tri, n, 44)
    n_tri = np.maximum(np.bincount(tri_row, minlength=n), 1)
    length = words.stop - words.start
    stats = np.concatenate([
        classes / np.maximum(size, 1)[:, None],
        np.stack([
            np.log1p(words.count) / 12,
            np.bincount(words.doc, length, minlength=n) / nw / 20,
            np.bincount(words.doc, near, minlength=n) / nw,
            np.bincount(row48, minlength=n) / nw,
            np.bincount(tri48, minlength=n) / n_tri,
            np.log1p(classes[:, 4] / nw * 100) / 5,
            classes[:, 1] / np.maximum(classes[:, 0] + classes[:, 1] + classes[:, 7], 1),
        ], 1)], 1)
    stats = np.clip(stats, 0, 1)
    w_row, w_idx, w_count = _distinct(words.doc, words.hash, n, WORD_BITS)
    norm = np.sqrt(np.bincount(w_row, w_count.astype(float) ** 2, minlength=n))
    base = 1 << WORD_BITS
    s_row = np.repeat(np.arange(n), N_STATS)
    s_idx = np.tile(base + np.arange(N_STATS), n)
    step = np.minimum((np.sqrt(stats) * _STEPS).astype(int), _STEPS - 1)
    b_idx = (base + N_STATS + np.arange(N_STATS) * _STEPS + step).ravel()
    rows = np.concatenate([w_row, s_row, s_row])
    idx = np.concatenate([w_idx, s_idx, b_idx])
    val = np.concatenate([w_count / norm[w_row], stats.ravel(), np.full(len(b_idx), 0.5)])
    order = np.argsort(rows, kind="stable")
    return np.searchsorted(rows[order], np.arange(n + 1)), idx[order], val[order]


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, bounds, idx, val) -> np.ndarray:
        """Scores of sparse rows by the sum-of-squares identity."""
        vx = self.v[idx] * val[:, None]
        at = bounds[:-1]
        lin = np.add.reduceat(self.w[idx] * val, at)
        s = np.add.reduceat(vx, at, axis=0)
        q = np.add.reduceat(vx * vx, at, axis=0)
        return self.w0 + lin + 0.5 * (s * s - q).sum(1)

    def score(self, bounds, idx, val) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(bounds, idx, val), -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, factors: int = FACTORS,
        epochs: int = 12, batch: int = 256, rate: float = 0.02, decay: float = 1e-5, seed: int = 7) -> Machine:
    """Mini-batch Adam on the logistic loss (fixed seed: repeatable)."""
    rng = np.random.default_rng(seed)
    v = rng.normal(0, 0.05, (WIDTH, factors))
    if not len(rows) or labels.min() == labels.max():
        p = (labels.mean() if len(rows) else 0.5) * 0.98 + 0.01
        return Machine(float(np.log(p / (1 - p))), np.zeros(WIDTH), np.zeros((WIDTH, factors)))
    theta = np.concatenate([np.zeros((WIDTH, 1)), v], 1)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    w0, step = float(np.log(labels.mean() / (1 - labels.mean()))), 0
    b1 = b2 = 0.0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            part = order[lo:lo + batch]
            idx = np.concatenate([rows[r][0] for r in part])
            val = np.concatenate([rows[r][1] for r in part])
            bounds = np.r_[0, np.cumsum([len(rows[r][0]) for r in part])]
            now = Machine(w0, theta[:, 0], theta[:, 1:])
            gap = (now.score(bounds, idx, val) - labels[part]) / len(part)
            per = np.repeat(gap, np.diff(bounds)) * val
            vi = theta[idx, 1:]
            s = np.add.reduceat(vi * val[:, None], bounds[:-1], axis=0)
            pull = per[:, None] * (np.repeat(s, np.diff(bounds), axis=0) - vi * val[:, None])
            grad = np.stack([np.bincount(idx, per, WIDTH)]
                            + [np.bincount(idx, pull[:, f], WIDTH) for f in range(factors)], 1)
            grad += decay * theta
            step += 1
            m1 = 0.9 * m1 + 0.1 * grad
            m2 = 0.999 * m2 + 0.001 * grad * grad
            theta -= rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
            g0 = gap.sum()
            b1, b2 = 0.9 * b1 + 0.1 * g0, 0.999 * b2 + 0.001 * g0 * g0
            w0 -= rate * (b1 / (1 - 0.9 ** step)) / (np.sqrt(b2 / (1 - 0.999 ** step)) + 1e-8)
    return Machine(w0, theta[:, 0].copy(), theta[:, 1:].copy())


def label_sample(labels: DataFrame, label_col: str, max_train: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``max_train`` labelled ids of the training folds (bounded, so
    it may be broadcast)."""
    return (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
                  .select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y"))
                  .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_train))


def _feature_rows(batches):
    for batch in batches:
        data, offs = buffers(batch.column(1))
        y = batch.column(0)
        for i, j in slices(offs):
            bounds, idx, val = features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            lists = lambda x, t: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, t))
            yield pa.RecordBatch.from_arrays(
                [y.slice(i, j - i), lists(idx, pa.int32()), lists(val, pa.float32())], names=["y", "idx", "val"])


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", max_train: int = MAX_TRAIN, **fit_options) -> Machine:
    """Fit on at most ``max_train`` labelled documents; their ids are
    broadcast, so the document scan stays in place. Of an id that stands for
    several texts the one of the smallest hash is taken."""
    bounded_batches(docs.sparkSession)
    sample = label_sample(labels, label_col, max_train)
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
                .join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y")
                .agg(F.min_by("t", F.struct(F.xxhash64("t"), "t")).alias("t")).select("y", "t")
                .mapInArrow(_feature_rows, "y double, idx array<int>, val array<float>").toArrow())
    idx = [np.asarray(x.values, dtype=np.int64) for x in rows.column("idx")]
    val = [np.asarray(x.values, dtype=np.float64) for x in rows.column("val")]
    y = rows.column("y").to_numpy()
    # a fixed order, so that the fit does not depend on the order of arrival
    order = sorted(range(len(y)), key=lambda r: (y[r], len(idx[r]), idx[r].tobytes(), val[r].tobytes()))
    return fit([(idx[r], val[r]) for r in order], y[order], **fit_options)


def scores(batches, machine: Machine, text_at: int):
    """(batch, scores of its rows)."""
    for batch in batches:
        data, offs = buffers(batch.column(text_at))
        parts = [machine.score(*features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])) for i, j in slices(offs)]
        yield batch, np.concatenate(parts or [np.empty(0)])


def score_documents(docs: DataFrame, machine: Machine, *, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and the prediction of every row."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for batch, s in scores(batches, held.value, 2):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()),
                 pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    source = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                         F.col(text_col).alias("t"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accept(docs: DataFrame, machine: Machine, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents the classifier accepts, with all their columns (a filter
    inside the scan tasks)."""
    bounded_batches(docs.sparkSession)
    held, at = docs.sparkSession.sparkContext.broadcast(machine), docs.columns.index(text_col)

    def run(batches):
        for batch, s in scores(batches, held.value, at):
            yield batch.filter(pa.array(s >= threshold))

    return docs.mapInArrow(run, docs.schema)
