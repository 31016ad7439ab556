"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

A short item inside a long document has a tiny Jaccard similarity, which MinHash cannot see. So items are
partitioned by size (powers of two), and for each size class the documents' shingles are cut into segments of
about that size: inside a segment that holds part of the item, the similarity is large again. Every segment
has one minimum per hash function. An item is a candidate for a document when at least one of the item's
minima is also the minimum of one of the document's segments; with the shares used here a contained item is
missed with a probability below 1e-8. Candidates are verified on the document's whole set of shingles,
wherever in the text they are.

Item minima are looked up through a bit table of fixed size, so what is sent to the tasks does not grow with
the benchmark; rows that pass are joined to the minima exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm import textops as X
from flowlake.llm.bitset import bitset, present
from flowlake.llm.scratch import Scratch

#: Minima per segment and item.
HASHES = 64
_RNG = np.random.Generator(np.random.PCG64(5))
_FACTORS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_FLIPS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
#: Shingles whose minima are taken at once.
_PORTION = 1 << 16


def size_class(n: int) -> int:
    """0 for one shingle, then 1 for two, 2 for three and four, 3 for five to eight ..."""
    return max(n - 1, 0).bit_length()


def _minima(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each segment (rows) and hash function (columns) the smallest 32-bit hash."""
    low = (h >> np.uint64(32)).astype(np.uint32)
    return np.stack([np.minimum.reduceat((low ^ f) * m, starts) for f, m in zip(_FLIPS, _FACTORS, strict=True)], axis=1)


def _register_keys(minima: np.ndarray, level: int) -> np.ndarray:
    salt = X.mixed(np.arange(HASHES, dtype=np.uint64) + np.uint64(1000 * level))
    return X.mixed(minima.astype(np.uint64) ^ salt)


def _items(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(X.shingle_sets(X.raw_texts(batch.column(1)), width))
            levels = [size_class(len(s)) for s in sets]
            keys = [_register_keys(_minima(s, np.zeros(1, np.int64)), k).ravel() if len(s) else s for s, k in zip(sets, levels, strict=True)]
            columns = [batch.column(0), pa.array(levels, pa.int32())]
            columns += [X.long_lists([X.signed(v) for v in part]) for part in (sets, keys)]
            yield pa.record_batch(columns, ["item_id", "level", "hashes", "keys"])

    return run


def _segment_keys(hashes: np.ndarray, runs: np.ndarray, levels: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, register key) of all segments of all size classes.

    The finest segments' minima are computed once; a coarser segment's minimum is the smallest of them.
    """
    finest = 1 << levels[0]
    per_text = -(-runs // finest)
    text = np.repeat(np.arange(len(runs)), per_text)
    within = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    starts = np.repeat(np.cumsum(runs) - runs, per_text) + within * finest
    minima = _minima(hashes, starts)
    for level in levels:
        ratio = (1 << level) // finest
        first = np.flatnonzero(within % ratio == 0)
        merged = np.minimum.reduceat(minima, first, axis=0) if ratio > 1 else minima
        yield text[first], _register_keys(merged, level)


def _hits(width: int, levels: list[int], bits):
    """Texts that share a minimum with an item, perhaps; with the register keys that passed the filter."""

    def run(batches):
        table = bits.value
        for batch in batches:
            texts = X.raw_texts(batch.column(1))
            rows, keys = [], []
            for a, b in X.pieces(texts):
                words = X.Words(texts[a:b])
                hashes, runs = X.grams(words.hashes, words.counts, width)
                if not len(hashes):
                    continue
                at = [np.zeros(0, np.int64)]
                found = [np.zeros(0, np.uint64)]
                for text, key in _segment_keys(hashes, runs, levels):
                    row, column = np.nonzero(present(table, key))
                    at.append(text[row])
                    found.append(key[row, column])
                at, found = np.concatenate(at), np.concatenate(found)
                for t in np.unique(at).tolist():
                    rows.append(a + t)
                    keys.append(X.signed(np.unique(found[at == t])))
            if rows:
                part = batch.take(pa.array(rows))
                yield pa.record_batch([part.column(0), part.column(1), X.long_lists(keys)], ["doc_id", "text", "keys"])

    return run


def _contained(width: int, share: Fraction):
    """Exact share of the item's shingles that the whole text has; columns uid, text, item_id, hashes."""

    def run(batches):
        for batch in batches:
            n, found, keep = [], [], []
            sets = X.shingle_sets(X.raw_texts(batch.column(2)), width)
            for s, item in zip(sets, batch.column(4), strict=True):
                item = np.asarray(item.values).view(np.uint64)
                both = int(np.isin(item, s, assume_unique=True).sum())
                n.append(len(item))
                found.append(both)
                keep.append(both * share.denominator >= share.numerator * len(item))
            columns = [batch.column(0), batch.column(1), batch.column(3), pa.array(n, pa.int64()), pa.array(found, pa.int64())]
            out = pa.record_batch(columns, ["uid", "doc_id", "item_id", "n_item", "n_found"])
            yield out.filter(pa.array(keep, pa.bool_()))

    return run


class Contamination:
    """Which documents contain which benchmark items.

    An item is contained when the document has at least ``share`` of the item's distinct shingles of
    ``width`` words (an item or a document with fewer words is one shingle of all its words). Null and empty
    texts contain nothing and are contained in nothing. Rows without an id and rows that repeat one are
    searched like all others. Other columns are not looked at.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame, width: int = 5, share: float = 0.8):
        self.docs, self.benchmark = docs, benchmark
        self.width, self.share = width, Fraction(str(share))
        self.scratch = Scratch(docs.sparkSession, "contamination")

    def _matches(self) -> tuple[DataFrame, DataFrame | None]:
        s, spark = self.scratch, self.docs.sparkSession
        schema = "item_id long, level int, hashes array<long>, keys array<long>"
        items = self.benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(_items(self.width), schema)
        # Items with equal shingles are searched once.
        items = items.where(F.size("hashes") > 0).withColumn("iid", F.monotonically_increasing_id())
        items = s.store(items, "items")
        empty = "uid long, doc_id long, item_id long, n_item long, n_found long"
        # At most one level for each power of two.
        levels = sorted(r.level for r in items.select("level").distinct().collect())
        if not levels:
            return spark.createDataFrame([], empty), None
        minima = s.store(items.select("iid", "item_id", F.explode("keys").alias("key")), "minima")
        bits = bitset(minima, F.col("key"))
        docs = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        hits = docs.mapInArrow(_hits(self.width, levels, bits), "doc_id long, text string, keys array<long>")
        hits = s.store(hits.withColumn("uid", F.monotonically_increasing_id()), "hits")
        bits.destroy()
        pairs = hits.select("uid", F.explode("keys").alias("key")).join(minima, "key").select("uid", "iid").distinct()
        pairs = s.store(pairs, "candidates")
        full = pairs.join(items.select("iid", "item_id", "hashes"), "iid").join(hits.drop("keys"), "uid")
        full = full.select("uid", "doc_id", "text", "item_id", "hashes")
        return full.mapInArrow(_contained(self.width, self.share), empty), hits

    def pairs(self) -> DataFrame:
        """``doc_id, item_id, n_item, n_found``: one row per contaminated row of documents and row of items."""
        return self._matches()[0].drop("uid")

    def clean(self) -> DataFrame:
        """The documents that contain no item, with all their columns."""
        found, hits = self._matches()
        if hits is None:
            return self.docs
        uids = found.select("uid").distinct()
        key = F.xxhash64("text")
        bad = hits.join(uids, "uid", "left_semi").select(F.col("doc_id").alias("__leak_id"), key.alias("__leak_text")).distinct()
        bad = self.scratch.store(bad, "contaminated")
        here = F.col("doc_id").cast("long").eqNullSafe(F.col("__leak_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__leak_text"))
        return self.docs.join(bad, here, "left_anti")

