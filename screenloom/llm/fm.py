"""A quality classifier: a factorisation machine over hashed words, structure and metadata.

score(x) = w0 + sum w_i x_i + sum over i < j of <v_i, v_j> x_i x_j, where the pairs
are computed in linear time as half of |sum v_i x_i|^2 - sum |v_i x_i|^2.

Features are the buckets of the distinct hashed words, each of weight
1 / sqrt(their number), and one of weight 1 for the bin of each structure
statistic and of the metadata.  The model is fitted on a bounded sample of
labelled rows and sent to the tasks that score all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import spread
from .repetition import SYMBOLS, duplicate_lines, per_row
from .words import raw, split, word_hashes

#: Labelled rows of each class that the model is fitted on, at most.
SAMPLE = 3000
BUCKETS, RANK, EPOCHS, BATCH, RATE, DECAY = 1 << 14, 8, 12, 128, 0.1, 1e-4
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
STEP_BYTES = 2 << 20
BINS = 12


def _flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


UPPER, DIGIT, POINT = _flags(bytes(range(65, 91))), _flags(b"0123456789"), _flags(b".,;:!?\"'()-")
EXCLAIM = _flags(b"!")
STATISTICS = ["words", "word_bytes", "symbols", "upper", "digits", "points", "exclaims", "distinct", "top_word", "dup_lines", "line_words", "n_chars"]
SIZE = BUCKETS + len(STATISTICS) * (BINS + 1)


def _bin(values: np.ndarray, low: float, high: float) -> np.ndarray:
    """Equal bins between low and high."""
    return np.clip((values - low) / (high - low) * BINS, 0, BINS - 1).astype(np.int64)


def features(texts: pa.Array, n_chars: pa.Array | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all texts, in order of rows."""
    words = split(texts)
    data, at = raw(texts)
    n, counts, size = len(texts), words.counts, np.maximum(np.diff(at), 1)
    hashes = word_hashes(words)
    _, code = np.unique(hashes, return_inverse=True)
    pairs, times = np.unique(words.row * (int(code.max(initial=0)) + 1) + code, return_counts=True)
    owner = pairs // (int(code.max(initial=0)) + 1)
    distinct, top = np.bincount(owner, minlength=n), np.zeros(n)
    np.maximum.at(top, owner, times)
    some = np.maximum(counts, 1)
    dup = np.array([duplicate_lines(data[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)], np.int64)
    lines = per_row(at, data == 10) + 1
    share = lambda flags: np.sqrt(per_row(at, flags[data]) / size)
    chars = np.zeros(n) if n_chars is None else n_chars.cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False)
    bins = [
        _bin(np.log2(counts + 1), 0, 15), _bin(np.bincount(words.row, words.end - words.start, n) / some, 0, 15), _bin(share(SYMBOLS), 0, 0.6), _bin(share(UPPER), 0, 1), _bin(share(DIGIT), 0, 0.6),
        _bin(share(POINT), 0, 0.7), _bin(share(EXCLAIM), 0, 0.6), _bin(distinct / some, 0, 1), _bin(np.sqrt(top / some), 0, 1), _bin(np.sqrt(dup / lines), 0, 1), _bin(np.log2(some / lines + 1), 0, 10),
        np.where(chars < 0, BINS, _bin(np.log2(np.maximum(chars, 0) + 1), 0, 20)),
    ]
    hashed = np.unique(words.row * BUCKETS + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64))
    row, bucket = hashed // BUCKETS, hashed % BUCKETS
    weight = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))[row]
    rows = np.concatenate([row, *[np.arange(n)] * len(bins)])
    feature = np.concatenate([bucket, *[BUCKETS + i * (BINS + 1) + b for i, b in enumerate(bins)]])
    value = np.concatenate([weight, np.ones(n * len(bins))])
    order = np.argsort(rows, kind="stable")
    return rows[order], feature[order], value[order]


@dataclass
class Machine:
    """w0, w (linear) and v (rank columns)."""

    w0: float
    w: np.ndarray
    v: np.ndarray

    def parts(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores (log odds) and the sums of v_i x_i of each row."""
        if not len(row):
            return np.full(n, self.w0), np.zeros((n, self.v.shape[1]))
        begin = np.searchsorted(row, np.arange(n))
        full = np.append(begin[1:], len(row)) > begin
        vx = self.v[feature] * value[:, None]
        sums, squares, linear = np.zeros((n, vx.shape[1])), np.zeros(n), np.zeros(n)
        sums[full] = np.add.reduceat(vx, begin[full])
        squares[full] = np.add.reduceat((vx * vx).sum(1), begin[full])
        linear[full] = np.add.reduceat(self.w[feature] * value, begin[full])
        return self.w0 + linear + 0.5 * ((sums * sums).sum(1) - squares), sums


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray) -> Machine:
    """Logistic loss by AdaGrad over mini-batches in a fixed order."""
    rng = np.random.default_rng(7)
    m = Machine(0.0, np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, RANK)))
    if not len(labels):
        return Machine(0.0, m.w, np.zeros_like(m.v))
    prior = np.clip((labels * weights).sum() / weights.sum(), 1e-3, 1 - 1e-3)
    m.w0 = float(np.log(prior / (1 - prior)))
    g0, gw, gv = 1e-8, np.full(SIZE, 1e-8), np.full((SIZE, RANK), 1e-8)
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // BATCH)):
            row = np.repeat(np.arange(len(part)), [len(examples[i][0]) for i in part])
            feature, value = (np.concatenate([examples[i][k] for i in part]) for k in (0, 1))
            z, sums = m.parts(row, feature, value, len(part))
            d = (1 / (1 + np.exp(-z)) - labels[part]) * weights[part] / len(part)
            used, place = np.unique(feature, return_inverse=True)
            dx = d[row] * value
            dw = np.bincount(place, dx, len(used)) + DECAY * m.w[used]
            dv = np.zeros((len(used), RANK))
            np.add.at(dv, place, dx[:, None] * (sums[row] - m.v[feature] * value[:, None]))
            dv += DECAY * m.v[used]
            g0 += d.sum() ** 2
            m.w0 -= RATE * d.sum() / np.sqrt(g0)
            gw[used] += dw * dw
            m.w[used] -= RATE * dw / np.sqrt(gw[used])
            gv[used] += dv * dv
            m.v[used] -= RATE * dv / np.sqrt(gv[used])
    return m


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", sample: int = SAMPLE) -> Machine:
    """Fit on at most `sample` labelled rows of each class, those with the smallest hash of the key.

    labels: key and quality (0 or 1; null rows are left out).  The classes count as
    often as they are in labels.  No labels: every score is one half.
    """
    given = labels.select(F.col(key).alias("key"), F.col("quality").cast("int").alias("y")).where("key IS NOT NULL AND y IN (0, 1)")
    counts = {r.y: r["count"] for r in given.groupBy("y").count().collect()}
    picked = None
    for y in counts:
        one = given.where(F.col("y") == y).orderBy(F.xxhash64("key"), "key").limit(sample)
        picked = one if picked is None else picked.unionByName(one)
    if picked is None:
        return fit([], np.empty(0), np.empty(0))
    picked = picked.dropDuplicates(["key"])
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), (F.col(n_chars) if n_chars else F.lit(None)).cast("double").alias("n_chars"))
    rows = rows.join(F.broadcast(picked), "key")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in spread(batch["text"], STEP_BYTES):
                part = batch.slice(a, b - a)
                row, feature, value = features(part["text"], part["n_chars"])
                at = pa.array(np.searchsorted(row, np.arange(len(part) + 1)), pa.int32())
                yield pa.record_batch({"key": part["key"].cast(pa.string()), "y": part["y"], "feature": pa.ListArray.from_arrays(at, pa.array(feature, pa.int32())), "value": pa.ListArray.from_arrays(at, pa.array(value, pa.float32()))})

    found = rows.mapInArrow(extract, "key string, y int, feature array<int>, value array<float>").dropDuplicates(["key"]).limit(2 * sample).toArrow().sort_by("key")
    y = found["y"].to_numpy().astype(float)
    weights = np.ones(len(y))
    for c, n in counts.items():
        weights[y == c] = n / max((y == c).sum(), 1)
    examples = [(np.array(f), np.array(v)) for f, v in zip(found["feature"].to_pylist(), found["value"].to_pylist(), strict=True)]
    return fit(examples, y, weights / weights.mean() if len(y) else weights)


def score_quality(docs: DataFrame, machine: Machine, text: str = "text", n_chars: str | None = "n_chars", name: str = "score") -> DataFrame:
    """docs with `score`, between 0 and 1: the probability of quality 1 (a column of that name is replaced).

    Null and empty texts are scored by their structure alone; a null n_chars has a
    bin of its own.  Other columns, null and repeated keys are carried along.
    Empty table: empty result.
    """
    keep = [c for c in docs.columns if c != name]
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"), (F.col(n_chars) if n_chars else F.lit(None)).cast("double").alias("n_chars"))
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # SIZE * (RANK + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for a, b in spread(batch["text"], STEP_BYTES):
                part = batch.slice(a, b - a)
                z, _ = m.parts(*features(part["text"], part["n_chars"]), len(part))
                yield pa.record_batch({"row": part["row"], "score": pa.array(1 / (1 + np.exp(-z)), pa.float64())})

    out = rows.mapInArrow(run, rows.select("row").schema.add("score", "double"))
    return out.select(*[F.col("row")[c].alias(c) for c in keep], F.col("score").alias(name))
