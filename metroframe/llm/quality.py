"""Quality classifier: hashed word n-gram logistic regression, trained with
FTRL-proximal updates and scored as sparse dot products.

A word is a run of letters and digits or a run of other visible characters,
so that punctuation is a feature of its own. Unigrams and bigrams are hashed
into 2^18 weights (all bigrams of a word with itself into one); a text is the vector of log(1 + count), scaled to length 1.

The model is fitted on a bounded sample: at most ``most_per_class`` labelled
rows of each class, those of the smallest hash of the id. Their hashed
features, no texts, go through one task in hash order. The model is 2^18 doubles
(2 MB), whatever the input. Scoring reads each text once, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.llm.common import named, sliced, texts_and_ids, unused

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x00-\x20]+")
BUCKET_BITS = 18
MOST_PER_CLASS = 3000
#: the words of longer texts are not held all at once
LONG = 4 << 20
EPOCHS = 3
#: FTRL-proximal: learning rate, its smoothing, and the two penalties
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.1, 0.01


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The text's sparse vector: distinct buckets, and their values (length 1
    in all; both empty without words)."""
    found = WORD.findall(text) if len(text) <= LONG else (m.group() for m in WORD.finditer(text))
    words = np.fromiter(map(zlib.crc32, found), np.uint64)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0)
    mix = np.uint64(0x9E3779B97F4A7C15)
    one = words * mix
    # a word that follows itself is one feature, whichever word it is
    two = np.where(words[:-1] == words[1:], np.uint64(1), one[:-1] ^ (words[1:] + np.uint64(1))) * mix
    buckets = (np.concatenate([one, two]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    where, count = np.unique(buckets, return_counts=True)
    value = np.log1p(count)
    return where, value / np.sqrt((value * value).sum())


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


class Ftrl:
    """Per-coordinate FTRL-proximal logistic regression; the bias is the last
    coordinate and is not penalised by L1."""

    def __init__(self) -> None:
        n = (1 << BUCKET_BITS) + 1
        self.z, self.n = np.zeros(n), np.zeros(n)

    def weights(self, where: np.ndarray) -> np.ndarray:
        z, n = self.z[where], self.n[where]
        l1 = np.where(where == len(self.z) - 1, 0.0, L1)
        w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, where: np.ndarray, value: np.ndarray, label: int, weight: float = 1.0) -> None:
        where, value = np.append(where, len(self.z) - 1), np.append(value, 1.0)
        w = self.weights(where)
        g = weight * (sigmoid(w @ value) - label) * value
        sigma = (np.sqrt(self.n[where] + g * g) - np.sqrt(self.n[where])) / ALPHA
        self.z[where] += g - sigma * w
        self.n[where] += g * g


def calibration(margins: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(slope, intercept) of Platt scaling: the logistic curve through the
    margins, both classes of equal weight, towards targets just inside 0 and 1
    so that separable classes keep a finite slope."""
    ones = labels == 1
    n1, n0 = ones.sum(), (~ones).sum()
    target = np.where(ones, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(ones, 0.5 / n1, 0.5 / n0)
    x = np.stack([margins, np.ones(len(margins))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (weight * (p - target)) + 1e-6 * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        w = w - np.clip(np.linalg.solve(curvature, gradient), -2, 2)
    return max(float(w[0]), 1e-3), float(w[1])


Row = tuple[tuple[np.ndarray, np.ndarray], int]


def train(rows: list[Row], epochs: int = EPOCHS) -> np.ndarray:
    """The weights, the bias last, from rows of a text's features and its label;
    both classes weigh the same in all. Every fifth text is kept from training and calibrates the scale of the scores.
    With one class only the model is near that class for every text, without
    labels 0.5."""
    model, labels = Ftrl(), [label for _, label in rows]
    if len(set(labels)) < 2:
        weights = np.zeros(len(model.z))
        weights[-1] = 0.0 if not labels else 5.0 if labels[0] else -5.0
        return weights
    kept = rows[::5]
    learned = [r for i, r in enumerate(rows) if i % 5] if len({y for _, y in kept}) == 2 else rows
    learned = learned if len({y for _, y in learned}) == 2 else rows
    share = {label: sum(y == label for _, y in learned) / len(learned) for label in (0, 1)}
    for _ in range(epochs):
        for (where, value), label in learned:
            model.learn(where, value, label, 0.5 / share[label])
    weights = model.weights(np.arange(len(model.z)))
    if len({y for _, y in kept}) == 2:
        margins = np.array([weights[where] @ value + weights[-1] for (where, value), _ in kept])
        slope, intercept = calibration(margins, np.array([y for _, y in kept]))
        weights = weights * slope
        weights[-1] += intercept
    return weights


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        most_per_class: int = MOST_PER_CLASS) -> np.ndarray:
    """Fit on at most ``most_per_class`` labelled rows of each class, taken in
    the order of a hash of the id. Null ids and labels other than 0 and 1 are
    left out; an id with both labels counts as 0; of several rows of an id that
    of the smallest text hash is learned. Features are hashed where the texts
    are read, so the one task that trains gets a numeric row per sampled id."""
    marked = labels.select(named(id_col).alias("doc_id"), named(label_col).cast("int").alias("label"))
    marked = marked.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    order = F.xxhash64("doc_id", F.lit(7))
    sample = None
    for label in (0, 1):
        part = marked.where(F.col("label") == label).orderBy(order, "doc_id").limit(most_per_class)
        sample = part if sample is None else sample.union(part)
    # the sample has at most 2 * most_per_class rows of two numbers
    picked = texts_and_ids(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")
    picked = picked.select(order.alias("place"), F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"), "label")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("text_key"), batch.column("label"), pa.array([w.astype("<i4").tobytes() for w, _ in found], pa.binary()),
                 pa.array([v.astype("<f8").tobytes() for _, v in found], pa.binary())], ["place", "text_key", "label", "where", "value"])

    # an id may stand in any number of rows: that of the smallest text hash is learned
    vector = F.min_by(F.struct("label", "where", "value"), "text_key").alias("v")
    chosen = picked.mapInArrow(vectors, "place long, text_key long, label int, where binary, value binary").groupBy("place").agg(vector)
    chosen = chosen.select("place", "v.label", "v.where", "v.value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(b.column(k).to_pylist() for k in ("place", "label", "where", "value"))))
        model = train([((np.frombuffer(where, "<i4").astype(np.int64), np.frombuffer(value, "<f8")), label) for _, label, where, value in rows])
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()])], ["model"])

    model = chosen.repartition(1).mapInArrow(run, "model binary").collect()
    return np.frombuffer(model[0].model) if model else train([])


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score",
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) and ``score_col``, which
    replaces a column of that name: the probability of label 1 from the whole
    text. Null texts score as empty ones: the bias alone. No other column is an
    input; every row stays."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != score_col]
    schema = docs.select(*map(named, keep)).withColumn(score_col, F.lit(0.0)).schema
    model = docs.sparkSession.sparkContext.broadcast(weights)  # 2 MB
    body, = unused(keep, "text")
    read = docs.select(*map(named, keep), F.coalesce(named(text_col), F.lit("")).cast("binary").alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in sliced(batches, body):
            out = []
            for text in batch.column(body).to_pylist():
                where, value = features(text)
                out.append(sigmoid(w[where] @ value + w[-1]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.float64())], [*keep, score_col])

    return read.mapInArrow(run, schema)
