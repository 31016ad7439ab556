"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are present or absent: words, pairs of neighbours, and pairs with one word between them, hashed
into a fixed number of coordinates. Every coordinate has its own learning rate, and the L1 term keeps most
weights at exactly zero, so the model that is sent to the tasks is small and of bounded size.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm import textops as X
from flowlake.llm.scratch import Scratch

DIMENSION = 1 << 20
#: Labelled rows the model is fitted on at most (those whose hashed id is smallest); a documented bound.
MOST_ROWS = 20_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 3.0, 1.0, 8.0, 1.0
#: The last coordinate is always present and carries no L1 term.
_BIAS = DIMENSION
_GAPS = (1, 2)


def features(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(text number, coordinate) of all grams of a few texts, repeats included."""
    words = X.Words(texts)
    h, text = words.hashes, np.repeat(np.arange(len(texts)), words.counts)
    rows, grams = [text], [X.mixed(h, 1)]
    for gap in _GAPS:
        same = text[gap:] == text[:-gap] if gap < len(text) else np.zeros(0, bool)
        left, right = (h[:-gap][same], h[gap:][same]) if gap < len(text) else (h[:0], h[:0])
        grams.append(X.mixed(X.mixed(left, 2 + gap) + right))
        rows.append(text[gap:][same] if gap < len(text) else text[:0])
    return np.concatenate(rows), (np.concatenate(grams) >> np.uint64(44)).astype(np.int32)


def packed(at: np.ndarray) -> bytes:
    """Sorted coordinates as compressed differences: about two bytes each."""
    steps = np.diff(at, prepend=0).astype("<u4")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    parts = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(parts.T).view("<u4").ravel(), dtype=np.int64)


def _listed(batches):
    """label, place, text -> label, place, distinct coordinates."""
    for batch in batches:
        texts, found = X.raw_texts(batch.column(2)), []
        for a, b in X.pieces(texts):
            row, at = features(texts[a:b])
            code = np.unique(row.astype(np.int64) * DIMENSION + at)
            found.extend(map(packed, np.split(code % DIMENSION, np.searchsorted(code // DIMENSION, np.arange(1, b - a)))))
        at = pa.array(found, pa.binary())
        yield pa.record_batch([batch.column(0), batch.column(1), at], ["label", "place", "at"])


class Ftrl:
    """The learner's state: z and n of every coordinate."""

    def __init__(self):
        self.z, self.n = np.zeros(DIMENSION + 1), np.zeros(DIMENSION + 1)
        self.l1 = np.full(DIMENSION + 1, L1)
        self.l1[_BIAS] = 0.0

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1[at], 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _fitted(batches):
    """One pass over the rows in their order; the weights that are not zero."""
    model, seen = Ftrl(), False
    for batch in batches:
        for label, at in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            model.learn(np.append(unpacked(at.as_buffer()), _BIAS), label)
            seen = True
    w = model.weights()
    at = np.flatnonzero(w) if seen else np.zeros(0, np.int64)
    yield pa.record_batch([pa.array(at), pa.array(w[at])], ["at", "w"])


class Toxicity:
    """A model fitted on ``labelled(doc_id, text, label)`` and applied to any texts.

    At most ``most_rows`` labelled documents are used, the same ones in every run. Rows with a null label
    or id are left out; of several rows with one id, the largest label and smallest text count. A null or
    empty text has no grams and gets the score of the bias. Without labelled rows every score is 0.5.
    """

    def __init__(self, labelled: DataFrame, most_rows: int = MOST_ROWS):
        spark, scratch = labelled.sparkSession, Scratch(labelled.sparkSession, "toxicity")
        place = F.xxhash64("doc_id").alias("place")
        known = labelled.where("doc_id IS NOT NULL AND label IS NOT NULL")
        # most_rows rows of one number.
        ids = known.select("doc_id", place).distinct().orderBy("place", "doc_id").limit(most_rows)
        rows = known.select("doc_id", F.col("text").cast("string").alias("text"), F.col("label").cast("int").alias("label"))
        rows = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "place").agg(F.max("label").alias("label"), F.min("text").alias("text"))
        listed = rows.select("label", "place", "text").mapInArrow(_listed, "label int, place long, at binary")
        # The method is sequential: the bounded sample goes through one task, row by row. It is sorted once, and
        # the file is read once per epoch.
        listed = scratch.store(listed.repartition(1).sortWithinPartitions("place", "label"), "features").select("label", "at")
        epochs = reduce(DataFrame.unionAll, [listed] * EPOCHS).coalesce(1)
        got = epochs.mapInArrow(_fitted, "at long, w double").toPandas()  # DIMENSION + 1 rows at most
        weights = np.zeros(DIMENSION + 1, dtype=np.float32)
        weights[got["at"].to_numpy()] = got["w"].to_numpy()
        self.nonzero = int((weights != 0).sum())
        self.weights: Broadcast = spark.sparkContext.broadcast((np.flatnonzero(weights), weights[weights != 0]))

    def scored(self, docs: DataFrame, into: str = "score") -> DataFrame:
        """``docs`` with the score (0 to 1) in column ``into``; rows and other columns stay as they are."""
        weights = self.weights
        kept = [c for c in docs.columns if c != into]
        place = kept.index("text")

        def run(batches):
            at, w = weights.value
            table = np.zeros(DIMENSION + 1)
            table[at] = w
            for batch in batches:
                texts, scores = X.raw_texts(batch.column(place).cast(pa.string())), []
                for a, b in X.pieces(texts):
                    row, code = features(texts[a:b])
                    used = table[code] != 0
                    pairs = np.unique(row[used].astype(np.int64) * DIMENSION + code[used])
                    total = np.bincount(pairs // DIMENSION, table[pairs % DIMENSION], b - a) + table[_BIAS]
                    scores.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
                if scores:
                    yield pa.record_batch([*(batch.column(i) for i in range(len(kept))), pa.array(np.concatenate(scores))], [*kept, into])

        fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(kept).dtypes)
        return docs.select(kept).mapInArrow(run, f"{fields}, `{into}` double")


def labelled_texts(docs: DataFrame, labels: DataFrame, learn: Column, most_rows: int = MOST_ROWS) -> DataFrame:
    """``doc_id, text, label`` of the labelled rows that may be learned from, a bounded number of ids."""
    rows = labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    ids = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id")).limit(most_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(ids), "doc_id")  # most_rows rows of two numbers
