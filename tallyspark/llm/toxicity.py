"""Toxicity scores from FTRL-proximal logistic regression (operator 3).

Features are the distinct hashed word unigrams (whole and by their first letters),
bigrams and skip-grams of a text.  The model is fitted on a bounded, documented sample of
labelled rows (``max_train_rows``, chosen by id hash); per-coordinate learning rates and
L1 leave few non-zero weights, which are broadcast (at most ``2**bits`` of them) and
applied to every document.

Labels are used for fitting only; label, language, source and id are no inputs of a score.

Results for odd input: null text scores as the empty text, which has no features and gets
the score of the intercept; repeated rows get equal scores; rows without an id get a score
(``held_out`` null); ids with several or null labels count as toxic if any label is 1, and
are left out if all are null; without any label every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import boxed, is_broadcastable
from tallyspark.llm.wordio import mix, split_words, text_slices, word_hashes

BITS = 20
SKIPS = (1, 2, 3)         # bigrams (1) and skip-grams over one and two words
STEM = 4                  # letters of a word's stem
MAX_TRAIN_ROWS = 10_000   # bound of the fitting sample
EPOCHS, ALPHA, BETA, L1, L2 = 5, 4.0, 1.0, 5.0, 0.1
_EDGE = ".,;:!?%*#$&|()[]{}<>\"'-_"


def text_features(texts: pa.Array, bits: int = BITS) -> Iterator[np.ndarray]:
    """Per text an array of feature numbers, with repetitions."""
    counts, codes, vocabulary = split_words(texts)
    words = pc.utf8_trim(pc.utf8_lower(pa.array(vocabulary, type=pa.string())), _EDGE)
    whole = word_hashes(words.to_numpy(zero_copy_only=False))
    stems = word_hashes(pc.utf8_slice_codeunits(words, 0, STEM).to_numpy(zero_copy_only=False))
    shift = np.uint64(64 - bits)
    with np.errstate(over="ignore"):
        single = np.stack([mix(whole) >> shift, mix(stems + np.uint64(7)) >> shift], axis=1).astype(np.int32)
        hashes, second = whole[codes], mix(whole + np.uint64(1))[codes]
        pairs = [(mix(hashes[:-gap] + second[gap:] * np.uint64(2 * gap + 1)) >> shift).astype(np.int32)
                 if len(hashes) > gap else np.empty(0, np.int32) for gap in SKIPS]
    singles = single[codes]
    stops = np.cumsum(counts)
    for a, b in zip((stops - counts).tolist(), stops.tolist()):
        yield np.concatenate([singles[a:b].reshape(-1), *(p[a:max(a, b - gap)] for gap, p in zip(SKIPS, pairs))])


class Ftrl:
    """FTRL-proximal with per-coordinate rates; the intercept starts at the class odds."""

    def __init__(self, bits: int, odds: float, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> None:
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.bias, self.bias_n = odds, 1.0
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) > self.l1, (np.sign(z) * self.l1 - z) / rate, 0.0)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = _sigmoid(self.bias + w.sum()) - label
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / self.alpha * w
        self.bias_n += g * g
        self.bias -= 0.1 * g / np.sqrt(self.bias_n)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, **rates) -> tuple[float, np.ndarray, np.ndarray]:
    """(intercept, feature numbers, weights) from (distinct features, label) rows."""
    toxic = sum(y for _, y in rows)
    model = Ftrl(bits, float(np.log((toxic + 0.5) / (len(rows) - toxic + 0.5))), **rates)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            model.learn(*rows[i])
    used = np.flatnonzero(np.abs(model.z) > model.l1)
    return model.bias, used.astype(np.int64), model.weights(used)


def in_fold(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is held out: crc32 of the id's text, modulo ``folds``, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS, bits: int = BITS) -> DataFrame:
    """The model as rows (feature, weight); feature -1 is the intercept.

    One task fits it: it holds the distinct features of at most ``max_train_rows`` texts.
    """
    sample = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id")))
              .groupBy(F.col("doc_id").alias("t_id")).agg(F.max(F.col("toxic").cast("int")).alias("y"))
              .orderBy(F.xxhash64("t_id"), "t_id").limit(max_train_rows))
    # a labelled id may be repeated in docs: one row for each id and text
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample) if is_broadcastable(max_train_rows) else sample,
                                                F.col("doc_id") == F.col("t_id"))
             .select("t_id", "y", F.coalesce("text", F.lit("")).alias("text")))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                blobs = [np.unique(f).tobytes() for f in text_features(part.column("text"), bits)]
                yield pa.RecordBatch.from_arrays([part.column("t_id"), part.column("y"), pa.array(blobs, pa.binary())],
                                                 names=["t_id", "y", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(f.as_buffer(), dtype=np.int32), y) for batch in batches  # views of the batches
                for y, f in zip(batch.column("y").to_pylist(), batch.column("features"))]
        if not rows:
            return
        bias, features, weights = fit(rows, bits)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(features, -1)), pa.array(np.append(weights, bias))],
                                         names=["feature", "weight"])

    features = texts.mapInArrow(featurise, "t_id long, y int, features binary").dropDuplicates()
    # the sample is bounded by max_train_rows, so one task may hold it; sorted: the fit repeats exactly
    return (features.repartition(1).sortWithinPartitions("t_id", "features")
            .mapInArrow(learn, "feature long, weight double"))


def _scorer(model: DataFrame, bits: int):
    """Column function text -> score; the model is collected (at most 2**bits + 1 rows)."""
    rows = model.toPandas()
    if rows.empty:
        return lambda text: F.lit(0.0)
    is_bias = rows["feature"] == -1
    shared = model.sparkSession.sparkContext.broadcast((float(rows.loc[is_bias, "weight"].iloc[0]),
                                                        rows.loc[~is_bias, "feature"].to_numpy(np.int64),
                                                        rows.loc[~is_bias, "weight"].to_numpy(np.float64)))

    @F.pandas_udf("double")
    def toxicity(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bias, at, values = shared.value
        weights = np.zeros(1 << bits)
        weights[at] = values
        active = weights != 0
        for part in parts:
            texts, out = pa.array(part, type=pa.string()), []
            for start, stop in text_slices(texts):
                for f in text_features(texts.slice(start, stop - start), bits):
                    out.append(_sigmoid(bias + weights[np.unique(f[active[f]])].sum()))
            yield pd.Series(out, dtype="float64")

    return lambda text: toxicity(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs(doc_id, text)``."""
    scorer = _scorer(train(docs, labels, max_train_rows), BITS)
    rows = docs.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), scorer(F.col("text")).alias("score"))
    return rows.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns unchanged."""
    scorer = _scorer(train(docs, labels, max_train_rows), BITS)
    return boxed(docs).withColumn("score", scorer(F.col("row.text"))).where(F.col("score") < threshold).select("row.*")
