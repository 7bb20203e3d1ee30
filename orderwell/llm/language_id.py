"""Language of a text: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords (runs of one to four bytes of
each word with its borders, hashed into a fixed number of buckets); a linear layer
on that mean gives one logit per language.  Buckets, embeddings and weights are
learnt by stochastic gradient descent in numpy from a bounded, documented number of
labelled documents whose subword counts are taken on the executors.  Further labelled
documents, not trained on, calibrate a temperature and the confidence below which a
prediction is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwell.llm.keys import fresh_name
from orderwell.llm.text import as_arrays, blocks

UNDETERMINED = "und"
BUCKETS, DIMENSIONS = 4096, 16
GRAMS = (1, 2, 3, 4)
#: Labelled documents used at most: three quarters train, a quarter calibrates.
SAMPLE_DOCS = 4000
EPOCHS, MIN_STEPS, BATCH, RATE = 15, 2000, 32, 0.5
#: A bucket holds a small share of a text, so its gradient is scaled up.
EMBEDDING_RATE = 200
#: Share of right calibration predictions that rejection may cost at most.
REJECT_QUANTILE = 0.001
REJECT_CEILING = 0.5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def held_out(id_col: str = "doc_id") -> Column:
    """The fold nothing is learnt from; a null id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def subword_counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Per text, how often each bucket is hit.

    A gram is hashed from its bytes, its length and whether it begins or ends a
    word.  Grams with white space are left out.
    """
    low = _LOWER[data].astype(np.uint32)
    space = _SPACE[data]
    edges = np.ones(len(data) + 2, dtype=bool)
    edges[1:-1] = space
    for first, last in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for at in range(first, last, 1 << 20):  # bounded memory for huge texts
            counts += _grams(low, space, edges, at, min(last, at + (1 << 20)), first, last)
        yield counts


def _grams(low, space, edges, at, end, first, last) -> np.ndarray:
    """Grams that begin in [at, end) and end before ``last``."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for n in GRAMS:
        stop = min(end, last - n + 1)
        if stop <= at:
            continue
        value = np.full(stop - at, n * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        clean = np.ones(stop - at, dtype=bool)
        for j in range(n):
            value = (value ^ low[at + j : stop + j]) * np.uint32(0x01000193)
            clean &= ~space[at + j : stop + j]
        begins = edges[at:stop].copy()
        closes = edges[at + n + 1 : stop + n + 1].copy()
        if at == first:
            begins[0] = True
        if stop + n - 1 == last:
            closes[-1] = True
        value ^= begins * np.uint32(0x5BD1E995) ^ closes * np.uint32(0x27D4EB2F)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        value ^= value >> np.uint32(13)
        counts += np.bincount(value[clean] & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return counts


@dataclass
class Model:
    """What prediction needs; its size does not depend on the data."""

    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        """Averaged embeddings through the linear layer, for rows of counts."""
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return (counts / total) @ self.embeddings @ self.weights + self.bias

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return _softmax(self.logits(counts) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sgd(model: Model, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
    """Plain stochastic gradient descent on cross-entropy, rate falling to zero."""
    steps, step = max(MIN_STEPS, EPOCHS * -(-len(x) // BATCH)), 0
    while step < steps:
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            rate = RATE * max(0.0, 1 - step / steps)
            means = x[rows] @ model.embeddings
            error = _softmax(means @ model.weights + model.bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            back = error @ model.weights.T
            model.weights -= rate * means.T @ error
            model.bias -= rate * error.sum(axis=0)
            model.embeddings -= rate * EMBEDDING_RATE * x[rows].T @ back
            step += 1


def _calibrate(model: Model, counts: np.ndarray, y: np.ndarray) -> None:
    """Temperature of least calibration loss, then the rejection threshold."""
    logits = model.logits(counts)
    grid = np.geomspace(0.05, 20, 60)
    losses = [
        -np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid
    ]
    model.temperature = float(grid[int(np.argmin(losses))])
    chances = model.probabilities(counts)
    right = chances[chances.argmax(axis=1) == y].max(axis=1, initial=0)
    if len(right):
        model.threshold = float(min(np.quantile(right, REJECT_QUANTILE), REJECT_CEILING))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        counts = list(subword_counts(*as_arrays(batch.column("text"))))
        hit = [np.flatnonzero(c) for c in counts]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang"),
                batch.column("key"),
                pa.array([h.astype("<u2").tobytes() for h in hit], pa.binary()),
                pa.array([c[h].astype("<u4").tobytes() for c, h in zip(counts, hit)], pa.binary()),
            ],
            names=["lang", "key", "buckets", "counts"],
        )


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS
) -> Model | None:
    """A model from the rows given (pass the training fold only); None without labels.

    Rows without a label, or whose text is null or has no letter, teach nothing.  Of
    the others about ``sample_docs`` are taken, by hash of text and label, and
    never more than twice that; texts count whole.  Only their bucket counts
    come to the driver.
    """
    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & has_letter(F.col("text"))
    )
    key = F.xxhash64("lang", F.col("text"))
    share = min(1.0, sample_docs / max(1, labelled.count()))
    chosen = labelled.withColumn("key", key).filter(F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0))
    rows = (
        chosen.mapInArrow(_feature_rows, "lang string, key long, buckets binary, counts binary")
        .limit(2 * sample_docs)
        .toPandas()
        .sort_values(["key", "lang"], kind="stable")
    )
    if not len(rows):
        return None
    languages = sorted(set(rows["lang"]))
    counts = np.zeros((len(rows), BUCKETS), dtype=np.float32)
    for i, (at, n) in enumerate(zip(rows["buckets"], rows["counts"])):
        counts[i, np.frombuffer(at, "<u2")] = np.frombuffer(n, "<u4")
    y = np.array([languages.index(lang) for lang in rows["lang"]])
    rng = np.random.default_rng(17)
    order = rng.permutation(len(rows))
    cut = len(rows) - len(rows) // 4
    fit, check = order[:cut], order[cut:]
    model = Model(
        languages,
        rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)),
        np.zeros((DIMENSIONS, len(languages))),
        np.zeros(len(languages)),
    )
    shares = counts[fit] / np.maximum(counts[fit].sum(axis=1, keepdims=True), 1)
    _sgd(model, shares, y[fit], rng)
    if len(check):
        _calibrate(model, counts[check], y[check])
    return model


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def _judge(model: Model | None, batch: pa.RecordBatch, text_col: str, readable_col: str):
    """Names, scores and rejections of a block of rows."""
    readable = batch.column(readable_col).to_numpy(zero_copy_only=False).astype(bool)
    if model is None:
        n = len(readable)
        return [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
    means = [
        (c / max(1, c.sum())) @ model.embeddings
        for c in subword_counts(*as_arrays(batch.column(text_col)))
    ]
    logits = np.array(means).reshape(-1, DIMENSIONS) @ model.weights + model.bias
    chances = _softmax(logits / model.temperature)
    names = [
        model.languages[b] if r else UNDETERMINED for b, r in zip(chances.argmax(axis=1), readable)
    ]
    score = np.where(readable, chances.max(axis=1), 0.0)
    return names, score, ~readable | (score < model.threshold)


def predict(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the id column, lang_pred, score, rejected.

    Reads nothing but the whole text.  A text that is null or has no letter is
    ``und`` with score 0 and rejected, as is everything without a model.
    ``rejected`` also marks a confidence below the calibrated threshold; lang_pred
    still names the likeliest language there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            names, score, rejected = _judge(model, batch, "text", "readable")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                names=["id", "lang_pred", "score", "rejected"],
            )

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), has_letter(text).alias("readable"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, lang_pred string, score double, rejected boolean"
    ).withColumnRenamed("id", id_col)


def drop_rejected(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language ``predict`` does not reject."""
    readable = fresh_name(docs, "readable")
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text_col):
            rejected = _judge(model, batch, text_col, readable)[2]
            yield batch.select(columns).filter(pa.array(~rejected))

    return docs.withColumn(readable, has_letter(F.col(text_col))).mapInArrow(run, docs.schema)
