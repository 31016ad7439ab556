"""Near-duplicate vectors by random-hyperplane signs in several tables, exact cosines and components.

Every table cuts the sphere with its own hyperplanes; vectors with equal signs meet in a bucket. Equal
vectors are one class first. Buckets are compared in blocks of bounded size, in double precision, and a pair
is counted in the first table where it meets only. What leaves a block is one row per linked vector (how
many others, and the smallest of its group in the block), never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.graph import components
from flowlake.llm.scratch import Scratch
from flowlake.llm.textops import mixed, signed

#: Vectors of a bucket that are compared with one another in one piece.
BLOCK = 512
#: Share of the pairs exactly at the threshold that may meet in no table.
MISSED = 0.001
_LEAST_BITS = 16


def layout(n: int, similarity: float) -> tuple[int, int]:
    """Sign bits per table, so that unrelated vectors seldom meet among ``n``, and tables for the recall."""
    bits = min(max(_LEAST_BITS, math.ceil(math.log2(max(n, 2)))), 48)
    meet = (1 - math.acos(similarity) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log1p(-meet))


def _planes(table: int, bits: int, width: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([11, table])).standard_normal((width, bits))


def _keys(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """One 64-bit bucket key for each vector and table."""
    weight = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    keys = [((x @ _planes(t, bits, x.shape[1])) >= 0) @ weight for t in range(tables)]
    salt = mixed(np.arange(1, tables + 1, dtype=np.uint64))
    return mixed(np.stack(keys, axis=1) ^ salt)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.asarray(v.values, dtype=np.float64) for v in column])


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first: squares of very large or small values stay finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _buckets(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                sizes = np.array([len(v) for v in batch.column(1)])
                for width in np.unique(sizes).tolist():  # vectors of other lengths never meet
                    part = batch.filter(pa.array(sizes == width))
                    keys = mixed(_keys(_unit(_matrix(part.column(1))), bits, tables), width)
                    cid = np.repeat(part.column(0).to_numpy(), tables)
                    table = np.tile(np.arange(tables, dtype=np.int32), len(part))
                    columns = [pa.array(signed(keys.ravel())), pa.array(table), pa.array(cid)]
                    yield pa.record_batch(columns, ["bucket", "tab", "cid"])

    return run


def _runs(key: np.ndarray) -> np.ndarray:
    return np.append(0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1)


def _group(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions by the links (i, j)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def _compared(bits: int, similarity: float):
    """(cid, links, least) for runs of equal (bucket, lo, hi); least: smallest class linked in the block."""

    def compare(run: pa.Table):
        cid, copies, side = (run.column(c).to_numpy() for c in ("cid", "copies", "side"))
        table = run.column("tab")[0].as_py()
        x = _unit(_matrix(run.column("embedding").combine_chunks()))
        cross = run.column("lo")[0].as_py() != run.column("hi")[0].as_py()
        left, right = (np.flatnonzero(side == k) for k in (0, 1)) if cross else (np.arange(len(cid)),) * 2
        close = x[left] @ x[right].T >= similarity - 1e-9
        if not cross:
            close = np.triu(close, 1)
        i, j = np.nonzero(close)
        i, j = left[i], right[j]
        # The matrix product may differ in the last digits; the decision is made on one plain sum.
        exact = (x[i] * x[j]).sum(axis=1) >= similarity
        i, j = i[exact], j[exact]
        if len(i) and table:
            used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
            keys = _keys(x[used], bits, table)
            a, b = back[: len(i)], back[len(i) :]
            new = np.ones(len(i), dtype=bool)
            for t in range(table):
                new &= keys[a, t] != keys[b, t]
            i, j = i[new], j[new]
        if len(i):
            links = np.bincount(i, copies[j], len(cid)) + np.bincount(j, copies[i], len(cid))
            order = np.argsort(cid)
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            least = cid[order][_group(rank[i], rank[j], len(cid))[rank]]
            held = links > 0
            columns = [cid[held], links[held].astype(np.int64), least[held]]
            yield pa.record_batch([pa.array(c) for c in columns], ["cid", "links", "least"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            cuts = _runs(np.stack([table.column(c).to_numpy() for c in ("bucket", "lo", "hi")])).tolist()
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield from compare(table.slice(a, b - a))
            held = table.slice(cuts[-1])
        if held is not None and len(held):
            yield from compare(held)

    return run


def near_vectors(vectors: DataFrame, similarity: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding)``.

    Two rows are linked when the cosine of their vectors, in double precision, is at least ``similarity``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest ``vec_id`` reachable.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
    vectors of different lengths. A row without ``vec_id`` takes no part: no links, null component, kept.
    Rows that repeat a ``vec_id`` count as rows and as one node. Other columns are not looked at.
    """
    spark, s = vectors.sparkSession, Scratch(vectors.sparkSession, "near-vectors")
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    sound = F.coalesce((F.size(x) > 0) & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding"))
    usable = rows.where(sound & F.col("vec_id").isNotNull())
    # + 0.0 turns -0.0 into 0.0: both are the same vector.
    digest = lambda seed: F.xxhash64(F.lit(seed), F.transform(x, lambda v: v + F.lit(0.0)))
    usable = s.store(usable.select("vec_id", "embedding", digest(1).alias("d1"), digest(2).alias("d2")), "usable")
    classes = usable.groupBy("d1", "d2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min("embedding").alias("embedding")
    )
    classes = s.store(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    bits, tables = layout(classes.count(), similarity)
    placed = classes.select("cid", "embedding").mapInArrow(_buckets(bits, tables), "bucket long, tab int, cid long")
    placed = s.store(placed, "buckets")
    crowded = placed.groupBy("bucket", "tab").agg(F.count("*").alias("size")).where("size > 1")
    crowded = s.store(crowded, "crowded")
    sides = placed.join(crowded, ["bucket", "tab"]).join(classes.select("cid", "copies", "embedding"), "cid")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    sides = sides.withColumn("own", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
    sides = sides.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "bucket", "tab", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "cid", "copies", "embedding",
    )
    sides = sides.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "cid")
    found = sides.mapInArrow(_compared(bits, similarity), "cid long, links long, least long")
    found = s.store(found.groupBy("cid", "least").agg(F.sum("links").alias("links")), "found")

    near = found.select(F.col("cid").alias("a"), F.col("least").alias("b"))
    # A repeated vec_id joins the classes of its vectors.
    ids = usable.join(classes.select("d1", "d2", "cid"), ["d1", "d2"]).select("vec_id", "cid")
    first = ids.groupBy("vec_id").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a != z")
    same = ids.join(first, "vec_id").select("a", F.col("cid").alias("b"))
    groups = components(near.unionByName(same), s)
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.join(groups.withColumnRenamed("node", "cid"), "cid", "left").join(links, "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    named = s.store(named.select("d1", "d2", "rep", "copies", "component", "links"), "named")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    labels = named.join(least, "component").select(
        "d1", "d2", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    labels = s.store(labels, "labels")
    linked = usable.select("vec_id", "d1", "d2").join(labels, ["d1", "d2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~(sound & F.col("vec_id").isNotNull()))
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    out = linked.unionByName(alone.withColumn("component_id", F.col("vec_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
