"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text has one feature for each bucket of its hashed words (its share of the words, square-rooted and
scaled to unit length), and STRUCTURE dense features: of its shape (lengths, shares of classes of
characters, repetition of words and lines) and of its metadata (the recorded n_chars, and whether there is
one).  All features have a weight and a vector of FACTORS numbers;
pairs of features interact by the product of their vectors, summed in linear time as half of the square
of the sum minus the sum of squares.

Fitting takes a bounded sample of labelled rows: about SAMPLE_ROWS of them, drawn by a hash of doc_id, and
never more than twice as many, however often a doc_id is repeated.  Their sparse features (not their texts) meet in one task, which runs EPOCHS of AdaGrad and returns the
model of (BUCKETS + STRUCTURE) x (FACTORS + 1) numbers.  Scoring reads every whole text in its own task.

Defined results: a null or empty text has no words, and its structure features decide.  Rows with a null
doc_id are held out.  Repeated rows are scored one by one; a doc_id with several labels teaches each of
them; without labelled rows every score is 0.5.  Labels other than 0 and 1 and null labels teach nothing.
Without a
column n_chars it counts as null; further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordspark.llm.common import held_out, share, table
from recordspark.llm.words import Words, pieces, split

BUCKETS, FACTORS, EPOCHS, BATCH, SEED = 1 << 14, 4, 12, 256, 5
SAMPLE_ROWS = 6000
RATE, DECAY = 0.08, 1e-5
THRESHOLD = 0.7
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
STRUCTURE = 16
_IS = {k: np.zeros(256, dtype=np.int64) for k in ("upper", "digit", "symbol", "stop", "bang", "comma", "high")}
for _k, _chars in {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&|<>", "stop": b".", "bang": b"!?", "comma": b",;:"}.items():
    _IS[_k][list(_chars)] = 1
_IS["high"][128:] = 1


@dataclass
class Sparse:
    """Rows of features: row r has the entries first[r] to first[r + 1] - 1."""

    first: np.ndarray
    index: np.ndarray
    value: np.ndarray


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def structure(words: Words, hashes: np.ndarray, distinct: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """The dense features of each text, each about between 0 and 1.  chars: the recorded n_chars, NaN where there is none."""
    data, offsets = words.data, words.offsets
    size = np.maximum(np.diff(offsets), 1)
    n = np.maximum(words.counts, 1)
    columns = [np.log1p(size) / 12, np.log1p(words.counts) / 10, _sums(words.end - words.start, words.first) / n / 10, distinct / n]
    columns += [_sums(flags[data], offsets) / size for flags in _IS.values()]
    same = np.zeros(len(hashes), dtype=np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    same[words.first[:-1][words.counts > 0]] = 0
    columns.append(_sums(same, words.first) / n)
    lines = _sums(data == 10, offsets) + 1
    columns.append(np.minimum(lines / n, 1.0))
    columns += [np.log1p(np.clip(np.nan_to_num(chars), 0, 1e12)) / 12, np.isnan(chars).astype(np.float64), np.ones(len(size))]
    return np.column_stack(columns)


def features(words: Words, chars: np.ndarray) -> Sparse:
    hashes = words.hashes()
    rows = len(words.counts)
    key = words.texts_of_words() * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    text = key // BUCKETS
    per = np.bincount(text, minlength=rows)
    value = np.sqrt(count / np.maximum(words.counts, 1)[text])  # the squares of a text sum to 1
    dense = structure(words, hashes, per, chars)
    first = np.concatenate(([0], np.cumsum(per + STRUCTURE)))
    index = np.empty(first[-1], dtype=np.int32)
    out = np.empty(first[-1], dtype=np.float32)
    at = np.arange(len(key)) + STRUCTURE * text
    index[at], out[at] = key % BUCKETS, value
    tail = (first[1:] - STRUCTURE)[:, None] + np.arange(STRUCTURE)
    index[tail], out[tail] = BUCKETS + np.arange(STRUCTURE, dtype=np.int32), dense
    return Sparse(first, index, out)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    @staticmethod
    def blank(seed: int = SEED) -> Machine:
        n = BUCKETS + STRUCTURE
        return Machine(0.0, np.zeros(n, dtype=np.float32), np.random.default_rng(seed).normal(0, 0.02, (n, FACTORS)).astype(np.float32))

    def raw(self, x: Sparse) -> tuple[np.ndarray, np.ndarray]:
        """The machine's value of each row, and the sums of its factors; each row has STRUCTURE entries at least."""
        if len(x.first) == 1:
            return np.zeros(0), np.zeros((0, FACTORS))
        scaled = self.factors[x.index] * x.value[:, None]
        sums = np.add.reduceat(scaled, x.first[:-1], axis=0)
        squares = np.add.reduceat((scaled * scaled).sum(axis=1), x.first[:-1])
        linear = np.add.reduceat(self.weight[x.index] * x.value, x.first[:-1])
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def scores(self, x: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x)[0].astype(np.float64), -30, 30)))

    def packed(self) -> bytes:
        return np.concatenate([[self.bias], self.weight, self.factors.ravel()]).astype(np.float32).tobytes()

    @staticmethod
    def unpacked(data: bytes) -> Machine:
        x = np.frombuffer(data, dtype=np.float32)
        n = BUCKETS + STRUCTURE
        return Machine(float(x[0]), x[1 : n + 1], x[n + 1 :].reshape(n, FACTORS))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = SEED) -> Machine:
    """rows: index, value and label of each text, in an order that doesn't depend on partitions."""
    m = Machine.blank(seed)
    y = np.array([r[2] for r in rows], dtype=np.float64)
    if not len(rows) or y.min() == y.max():
        m.factors[:] = 0
        m.bias = 0.0 if not len(rows) else float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        return m
    g_bias, g_weight, g_factors = 1e-6, np.full_like(m.weight, 1e-6), np.full_like(m.factors, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            chosen = order[i : i + BATCH]
            x = Sparse(np.concatenate(([0], np.cumsum([len(rows[r][0]) for r in chosen]))), np.concatenate([rows[r][0] for r in chosen]), np.concatenate([rows[r][1] for r in chosen]))
            value, sums = m.raw(x)
            error = (1 / (1 + np.exp(-np.clip(value, -30, 30))) - y[chosen]).astype(np.float32) / len(chosen)
            row = np.repeat(np.arange(len(chosen)), np.diff(x.first))
            pull = error[row] * x.value
            used, back = np.unique(x.index, return_inverse=True)
            d_weight = np.bincount(back, pull, len(used)) + DECAY * m.weight[used]
            scaled = m.factors[x.index] * x.value[:, None]
            each = pull[:, None] * (sums[row] - scaled)
            d_factors = np.column_stack([np.bincount(back, each[:, k], len(used)) for k in range(FACTORS)]) + DECAY * m.factors[used]
            d_bias = float(error.sum())
            g_bias += d_bias**2
            g_weight[used] += d_weight**2
            g_factors[used] += d_factors**2
            m.bias -= RATE * d_bias / g_bias**0.5
            m.weight[used] -= (RATE * d_weight / np.sqrt(g_weight[used])).astype(np.float32)
            m.factors[used] -= (0.5 * RATE * d_factors / np.sqrt(g_factors[used])).astype(np.float32)
    return m


def n_chars(docs: DataFrame) -> Column:
    """The recorded length, where the rows have one."""
    return (F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")).alias("n_chars")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, Sparse]]:
    """Batches with `text` and `n_chars`, and their features piece by piece."""
    for b in batches:
        chars = b.column(b.schema.get_field_index("n_chars")).to_numpy(zero_copy_only=False).astype(np.float64)
        for a, z, data, offsets in pieces(b, "text"):
            yield b, a, z, features(split(data, offsets), chars[a:z])


def train(docs: DataFrame, labels: DataFrame, learn: str, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """The model from a bounded sample of the labelled rows for which the SQL condition `learn` holds."""
    marked = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality")
    n = marked.count()
    drawn = marked.where(share("doc_id") < F.lit(sample_rows / max(n, 1)))
    # about sample_rows rows of 12 bytes, so the texts stay where they are
    rows = docs.where(learn).select("doc_id", "text", n_chars(docs)).join(F.broadcast(drawn), "doc_id")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, a, z, x in _read(batches):
            cells = [(x.index[x.first[i] : x.first[i + 1]].tobytes(), x.value[x.first[i] : x.first[i + 1]].tobytes()) for i in range(z - a)]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), b.column(3).slice(a, z - a).cast(pa.int32()), pa.array([c[0] for c in cells], pa.binary()), pa.array([c[1] for c in cells], pa.binary())], ["doc_id", "quality", "index", "value"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_ = sorted((d, i, v, q) for b in batches for d, q, i, v in zip(*(c.to_pylist() for c in b.columns), strict=True))
        m = fit([(np.frombuffer(i, dtype=np.int32), np.frombuffer(v, dtype=np.float32), q) for _, i, v, q in rows_])
        yield pa.RecordBatch.from_arrays([pa.array([m.packed()], pa.binary())], ["model"])

    x = rows.mapInArrow(extracted, "doc_id long, quality int, index binary, value binary")
    x = x.orderBy(F.xxhash64("doc_id", "index", "value")).limit(2 * sample_rows).repartition(1).mapInArrow(fitted, "model binary")
    found = x.collect()
    return Machine.unpacked(found[0]["model"]) if found else fit([])


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """Scores of every row of `docs` (doc_id, held_out, text)."""
    packed = model.packed()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine.unpacked(packed)
        for b, a, z, x in _read(batches):
            p = m.scores(x)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), b.column(1).slice(a, z - a), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "held_out", "text", n_chars(docs)).mapInArrow(scored, SCHEMA)


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars").withColumn("held_out", held_out("doc_id", 4, 2))
    return score(docs, train(docs, table(spark, sf_dir, "labels"), "not held_out"))
