"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlight.llm.pretokens import chunks_of
from spendlight.llm.words import scrambled, word_hashes

#: Features are numbers below two to this.
FEATURE_BITS = 22
#: Labelled rows that a model is fitted on, about; each is seen PASSES times.
TRAIN_ROWS = 20_000
PASSES = 3

#: Odd multipliers of pairs 1, 2 and 3 words ahead.
AHEAD = [np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of texts: the text's place and the feature, one entry per occurrence.

    A feature is a word, two neighbours, or two words with one or two others between them.
    """
    words, text_of = word_hashes(texts)
    found, of = [words], [text_of]
    for gap, step in enumerate(AHEAD, 1):
        same = text_of[gap:] == text_of[:-gap]
        found.append(scrambled(words[:-gap] * step + words[gap:])[same])
        of.append(text_of[gap:][same])
    hashed = np.concatenate(found) >> np.uint64(64 - FEATURE_BITS)
    return np.concatenate(of), hashed.astype(np.int64)


def feature_sets(texts: list[str]) -> list[np.ndarray]:
    """Distinct features of each text, ascending."""
    of, found = features(texts)
    keys = np.unique(of << FEATURE_BITS | found)
    ends = np.searchsorted(keys, np.arange(1, len(texts) + 1) << FEATURE_BITS)
    return np.split((keys & ((1 << FEATURE_BITS) - 1)).astype(np.int32), ends[:-1])


class Ftrl:
    """Follow-the-regularised-leader for logistic loss: a learning rate per coordinate, and weights held at 0 by l1."""

    def __init__(self, alpha: float = 3.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        size = (1 << FEATURE_BITS) + 1  # the last is the constant feature
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, found: np.ndarray, label: int) -> None:
        at = np.append(found, 1 << FEATURE_BITS)
        w = self.weights(at)
        g = _sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


# --- fitting ------------------------------------------------------------------


def held_out(doc_id: str) -> Column:
    """Rows that are never learned from: a fifth, by the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def drawn_labels(labels: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` labelled ids outside the held-out fifth, drawn by a hash: _id, _label, _draw."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("_label"))
        .where(~held_out("_id"))
    )
    share = min(1.0, rows / max(1, known.count()))
    return known.withColumn("_draw", F.xxhash64("_id")).where(F.pmod("_draw", F.lit(1 << 30)) < int(share * (1 << 30)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, passes: int = PASSES) -> Model:
    """Fit on about ``rows`` labelled documents outside the held-out fifth, drawn by a hash of the id.

    The bound is on the sample alone: FTRL goes through it row by row in one
    task, ``passes`` times in a fixed order, and holds one state however many
    rows come. Its labels are at most ``rows`` short rows and are broadcast. Of
    several labels of a document the largest counts; rows without an id, label
    or document are not learned from.
    """
    drawn = drawn_labels(labels, rows)
    found = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text")).join(
        F.broadcast(drawn), F.col("_doc") == F.col("_id")
    )

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in chunks_of(batch.column(2)):
                own = batch.slice(at, len(texts))
                sets = pa.array(feature_sets(texts), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), sets], names=["draw", "label", "found"])
                at += len(texts)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = Ftrl(), 0
        for batch in batches:
            sets = batch.column(1)
            values, ends = sets.values.to_numpy(), sets.offsets.to_numpy()
            for i, label in enumerate(batch.column(0).to_pylist()):
                state.learn(values[ends[i] : ends[i + 1]], label)
                seen += 1
        if seen:
            weights = state.weights(slice(None))
            used = np.append(np.flatnonzero(weights[:-1]), len(weights) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], names=["feature", "weight"])

    rows_in = found.select("_draw", "_label", "_text").mapInArrow(described, "draw long, label int, found array<int>")
    ordered = (
        rows_in.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(passes))))
        .repartition(1)
        .sortWithinPartitions("turn", "draw", "label", "found")
    )
    # At most one row per feature, and l1 leaves few of them.
    weights = ordered.select("label", "found").mapInArrow(learned, "feature long, weight double").collect()
    return Model([r["feature"] for r in weights], [r["weight"] for r in weights])


class Model:
    """Sparse weights; the feature after the last is the constant one. Without any row it rejects nothing."""

    def __init__(self, found: list[int], weights: list[float]):
        order = np.argsort(found, kind="stable")
        self.found, self.weights = np.array(found, np.int64)[order], np.array(weights, np.float64)[order]

    def table(self) -> np.ndarray:
        dense = np.zeros((1 << FEATURE_BITS) + 1, np.float32)
        dense[self.found] = self.weights
        return dense


def _scores(table: np.ndarray, texts: list[str]) -> np.ndarray:
    of, found = features(texts)
    used = np.flatnonzero(table[found])
    keys = np.unique(of[used] << FEATURE_BITS | found[used])
    margins = np.bincount(keys >> FEATURE_BITS, table[keys & ((1 << FEATURE_BITS) - 1)], len(texts))
    return _sigmoid(margins + table[-1])


@lru_cache(maxsize=1)
def _table(found: bytes, weights: bytes) -> np.ndarray:
    return Model(np.frombuffer(found, np.int64), np.frombuffer(weights)).table()


class _Scorer:
    """A model as a broadcast; a worker lays its weights out once."""

    def __init__(self, df: DataFrame, model: Model):
        self.known = len(model.found) > 0
        self.sent = df.sparkSession.sparkContext.broadcast((model.found.tobytes(), model.weights.tobytes()))

    def scores(self, column: pa.Array) -> np.ndarray:
        if not self.known:
            return np.zeros(len(column))
        table = _table(*self.sent.value)
        return np.concatenate([np.empty(0), *[_scores(table, texts) for texts in chunks_of(column)]])


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text decides the score; null and empty texts have that of the
    constant feature. A model without rows scores 0. Ids may be null (not held
    out) or repeat; other columns are not read. Nothing is shuffled.
    """
    scorer = _Scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scorer.scores(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents below the threshold, with all their columns whatever their names."""
    scorer, text = _Scorer(docs, model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scorer.scores(batch.column(text)) < threshold))

    return docs.mapInArrow(run, docs.schema)
