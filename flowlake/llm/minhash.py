"""Near-duplicate documents by HyperMinHash sketches, banding and exact verification.

1. Every text becomes a set of hashed word shingles; equal sets are one *class* from here on, so exact
   copies cost nothing further.
2. A class has a HyperMinHash sketch: the hash picks one of 128 buckets, the smallest remainder of a bucket
   is kept as its leading-zero count and ten mantissa bits (16 bits in all).
3. Four compressed registers make a band. Classes that share one of the 32 bands are candidates; sets too
   small to fill all buckets borrow registers along fixed probe orders.
4. Candidates are first compared with the leader of their band. In bands that then still hold several
   components, each class is compared with its nearest class of another component, and at last all pairs of
   different components that are left, in blocks. A group of copies costs a few comparisons per member and
   band, not the square, and no pair that could link two components is left out.
5. The collision-corrected Jaccard estimate rejects candidates that are six standard errors below the
   threshold; the rest is verified on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm import textops as X
from flowlake.llm.graph import components
from flowlake.llm.scratch import Scratch

BUCKETS, ROWS = 128, 4
BANDS = BUCKETS // ROWS
MANTISSA_BITS = 10
#: Fixed value: the constant of the expected-collision formula of the HyperMinHash paper.
_COLLISION = 0.169919487159739093975315012348
#: Classes of a band that are compared with one another in one piece.
BLOCK = 256
#: Rows of four numbers (16 MB) that are broadcast at most.
MOST_SENT = 1 << 19
_BUCKET_BITS = BUCKETS.bit_length() - 1
_EDGES = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - _BUCKET_BITS)
_PROBES = np.argsort(np.random.Generator(np.random.PCG64(7)).random((BUCKETS, BUCKETS)), axis=1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set of 64-bit hashes; 0 is an empty bucket."""
    first = np.searchsorted(hashes, _EDGES)
    held = first < np.append(first[1:], len(hashes))
    rest = (hashes[np.minimum(first, len(hashes) - 1)] << np.uint64(_BUCKET_BITS)) >> np.uint64(11)
    fraction, exponent = np.frexp(rest.astype(np.float64))
    mantissa = np.maximum((fraction * 2 - 1) * (1 << MANTISSA_BITS), 0).astype(np.int64)
    register = ((53 - exponent) << MANTISSA_BITS) + mantissa + 1
    return np.where(held, register, 0).astype(np.uint16)


def dense(registers: np.ndarray) -> np.ndarray:
    """The registers with empty buckets filled from the first full bucket of their probe order."""
    full = registers > 0
    gaps = np.flatnonzero(~full)
    if not len(gaps):
        return registers
    source = _PROBES[gaps, np.argmax(full[_PROBES[gaps]], axis=1)]
    out = registers.copy()
    out[gaps] = registers[source]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band for each row of (filled) registers."""
    parts = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    key = np.zeros(parts.shape[:2], dtype=np.uint64)
    for i in range(ROWS):
        key = (key << np.uint64(16)) | parts[:, :, i]
    return X.mixed(X.mixed(key) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows of registers less the collisions expected by chance, and buckets in use."""
    void = ((a == 0) & (b == 0)).sum(axis=-1) if not (a.all() or b.all()) else 0
    used = BUCKETS - void
    equal = np.count_nonzero(a == b, axis=-1) - void
    ratio = np.maximum(n_a, n_b) / np.maximum(np.minimum(n_a, n_b), 1)
    chance = BUCKETS * _COLLISION * 2.0**-MANTISSA_BITS * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(equal - chance, 0) / np.maximum(used, 1), used


def close_enough(guess: np.ndarray, used: np.ndarray, similarity: float) -> np.ndarray:
    """Whether an estimate is at most six standard errors below ``similarity``."""
    return guess >= similarity - 6 * np.sqrt(similarity * (1 - similarity) / np.maximum(used, 1))


_FEATURES = "doc_id long, n long, d1 long, d2 long, sig binary"


def _features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d1, d2, sig = [], [], [], []
            for s in X.shingle_sets(X.raw_texts(batch.column(1)), width):
                n.append(len(s))
                a, b = X.set_digest(s) if len(s) else (None, None)
                d1.append(a)
                d2.append(b)
                sig.append(sketch(s).tobytes() if len(s) else None)
            longs = [pa.array(v, pa.int64()) for v in (n, d1, d2)]
            yield pa.record_batch(
                [batch.column(0), *longs, pa.array(sig, pa.binary())], ["doc_id", "n", "d1", "d2", "sig"]
            )

    return run


def _registers(column: pa.Array) -> np.ndarray:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint16)[at[0] // 2 : at[-1] // 2].reshape(-1, BUCKETS)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, len(whole), 2048):
            batch = whole.slice(at, 2048)
            keys = band_keys(np.stack([dense(r) for r in _registers(batch.column(2))]))
            ids, sizes = (np.repeat(batch.column(i).to_numpy(), BANDS) for i in (0, 1))
            yield pa.record_batch([pa.array(X.signed(keys.ravel())), pa.array(ids), pa.array(sizes)], ["band", "cid", "n"])


def _likely(similarity: float):
    """Keep pairs whose estimate is plausible; columns a, b, n_a, n_b, sig_a, sig_b."""

    def run(batches):
        for batch in batches:
            n_a, n_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            if len(batch):
                keep = close_enough(*estimate(_registers(batch.column(4)), _registers(batch.column(5)), n_a, n_b), similarity)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


#: Rows of a block whose estimates against the whole block are worked out at once.
_SLAB = 32


def _open_blocks(similarity: Fraction, nearest: bool):
    """Pairs of different components inside runs of equal (band, lo, hi); see ``NearDuplicates._open``.

    With ``nearest`` each class's most similar plausible partner, unverified. Without, the pairs that hold on
    the full sets (column hashes); a pair that shares several bands is looked at in the first of them.
    """
    limit = float(similarity)

    def plausible(x: dict, same: bool):
        n, sig, comp, side = x["n"], x["sig"], x["comp"], x["side"]
        rows = np.arange(len(n)) if same or nearest else np.flatnonzero(side == 0)
        for at in range(0, len(rows), _SLAB):
            i = rows[at : at + _SLAB][:, None]
            ok = comp != comp[i]
            if not same:
                ok &= side != side[i]
            elif not nearest:
                ok &= np.arange(len(n)) > i
            ok &= np.minimum(n, n[i]) >= limit * np.maximum(n, n[i]) - 1e-9
            if ok.any():
                guess, used = estimate(sig[None, :, :], sig[i], n[None, :], n[i])
                yield i[:, 0], np.where(ok & close_enough(guess, used, limit), guess, -1.0)

    def found(x: dict, same: bool):
        cid, sig = x["cid"], x["sig"]
        for i, guess in plausible(x, same):
            if nearest:
                best = guess.argmax(axis=1)
                held = guess.max(axis=1) > 0
                yield cid[i[held]], cid[best[held]]
                continue
            row, j = np.nonzero(guess >= 0)
            if not len(row):
                continue
            i = i[row]
            used = np.unique(np.concatenate([i, j]))
            filled = np.zeros((len(sig), BANDS, ROWS), np.uint16)
            filled[used] = np.stack([dense(r) for r in sig[used]]).reshape(-1, BANDS, ROWS)
            band = np.flatnonzero(X.signed(band_keys(filled[used[:1]].reshape(1, -1))[0]) == x["band"][0])[0]
            first = (filled[i] == filled[j]).all(axis=2).argmax(axis=1) == band
            links = [(a, b) for a, b in zip(i[first].tolist(), j[first].tolist(), strict=True) if _similar(x["set"](a), x["set"](b), similarity)]
            if links:
                a, b = np.array(links).T
                yield cid[a], cid[b]

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            yield from blocks(table, last=False)
            held = table.slice(held_from(table))
        if held is not None and len(held):
            yield from blocks(held.combine_chunks(), last=True)

    def cuts(table):
        key = np.stack([table.column(c).to_numpy() for c in ("band", "lo", "hi")])
        return [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist()]

    def held_from(table):
        return cuts(table)[-1]

    def blocks(table, last: bool):
        """All runs of the table, but for its last one if more of it may follow."""
        ends = cuts(table) + [len(table)] * last
        x = {c: table.column(c).to_numpy() for c in ("band", "lo", "hi", "side", "cid", "comp", "n")}
        x["sig"] = _registers(table.column("sig").combine_chunks())
        lists = None if nearest else table.column("hashes").combine_chunks()
        out = []
        for a, b in zip(ends, ends[1:], strict=False):
            if (x["comp"][a:b] != x["comp"][a]).any():
                part = {c: v[a:b] for c, v in x.items()}
                part["set"] = lambda k, a=a: np.asarray(lists[a + k].values).view(np.uint64)
                out.extend(found(part, x["lo"][a] == x["hi"][a]))
        if out:
            a, b = (np.concatenate(v) for v in zip(*out, strict=True))
            yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def _similar(s: np.ndarray, t: np.ndarray, similarity: Fraction) -> bool:
    """Whether two sorted sets have at least that Jaccard similarity."""
    short, long = (s, t) if len(s) <= len(t) else (t, s)
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    both = int((long[at] == short).sum())
    return both * similarity.denominator >= similarity.numerator * (len(s) + len(t) - both)


def _own_sets(width: int):
    """Sets of the texts that really have the class's digest; columns cid, d1, d2, text."""

    def run(batches):
        for batch in batches:
            texts, cids, sets = X.raw_texts(batch.column(3)), [], []
            d1, d2 = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i, s in enumerate(X.shingle_sets(texts, width)):
                if X.set_digest(s) == (d1[i], d2[i]):
                    cids.append(batch.column(0)[i].as_py())
                    sets.append(X.signed(s))
                if sum(map(len, sets[-64:])) > 1 << 19 or len(sets) >= 2048:
                    yield pa.record_batch([pa.array(cids, pa.int64()), X.long_lists(sets)], ["cid", "hashes"])
                    cids, sets = [], []
            if cids:
                yield pa.record_batch([pa.array(cids, pa.int64()), X.long_lists(sets)], ["cid", "hashes"])

    return run


def _verified(similarity: Fraction):
    """Keep the pairs whose full sets are similar enough; columns a, b, set_a, set_b."""

    def run(batches):
        for batch in batches:
            sets = ((np.asarray(v.values).view(np.uint64) for v in pair) for pair in zip(batch.column(2), batch.column(3), strict=True))
            keep = [_similar(*pair, similarity) for pair in sets]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class NearDuplicates:
    """One search over ``docs``; ``result()`` has one row per row of ``docs``.

    ``doc_id, n_shingles, component_id, kept``: two documents are linked when the Jaccard similarity of
    their shingle sets is at least ``similarity``; ``component_id`` is the smallest ``doc_id`` reachable by
    links. A null or empty text has no shingles and is linked with nothing. A row without ``doc_id`` takes no
    part: its component is null and it is kept. Rows that repeat a ``doc_id`` are one document that has the
    links of all its texts. An empty table gives no rows. Other columns are not looked at.
    """

    def __init__(self, docs: DataFrame, width: int = 5, similarity: float = 0.8):
        self.spark = docs.sparkSession
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.width, self.similarity = width, Fraction(str(similarity))
        self.scratch = Scratch(self.spark, "near-duplicates")
        #: Full sets of the classes that were candidates so far.
        self.sets: DataFrame | None = None

    def result(self) -> DataFrame:
        s = self.scratch
        rows = s.store(self.docs.mapInArrow(_features(self.width), _FEATURES), "features")
        named = rows.where("doc_id IS NOT NULL AND n > 0")
        classes = named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("sig").alias("sig"))
        classes = s.store(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
        self.classes = classes
        members = s.store(classes.select("cid", "n", "sig").mapInArrow(_members, "band long, cid long, n long"), "members")
        leaders = members.groupBy("band").agg(F.min(F.struct("cid", "n")).alias("l"), F.count("*").alias("size"))
        leaders = leaders.where("size > 1").select("band", F.col("l.cid").alias("lead"), F.col("l.n").alias("n_l"), "size")
        leaders = s.store(leaders, "leaders")
        crowd = s.store(members.join(leaders, "band"), "crowd")  # members of bands that hold several classes
        s.drop(members)

        size_ok = (F.least("n", "n_l") * self.similarity.denominator) >= (F.greatest("n", "n_l") * self.similarity.numerator)
        stars = crowd.where(size_ok & (F.col("cid") != F.col("lead"))).select(F.col("lead").alias("a"), F.col("cid").alias("b"))
        links = s.store(self._links(self._likely(stars.distinct())), "links")
        same_id = self._same_id(named)
        links = links.unionByName(same_id)
        groups = s.store(components(links, s), "components")
        for nearest in (True, False):
            pairs = self._open(crowd, groups, nearest)
            more = s.store(self._links(pairs), "links") if nearest else pairs
            if not more.isEmpty():
                # The groups so far are stars: they stand for all earlier links.
                stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
                groups = s.store(components(stars.unionByName(more), s), "components")
        s.drop(crowd)
        return self._labelled(rows, groups)

    def _same_id(self, named: DataFrame) -> DataFrame:
        """Links between the classes of one repeated document id."""
        texts = named.groupBy("doc_id").agg(F.min(F.struct("d1", "d2")).alias("x"), F.max(F.struct("d1", "d2")).alias("y"))
        several = texts.where("x != y").select("doc_id")
        pairs = named.join(several, "doc_id").select("doc_id", "d1", "d2").distinct()
        pairs = pairs.join(self.classes.select("d1", "d2", "cid"), ["d1", "d2"])
        least = pairs.groupBy("doc_id").agg(F.min("cid").alias("a"))
        return pairs.join(least, "doc_id").select("a", F.col("cid").alias("b")).where("a != b")

    def _likely(self, pairs: DataFrame) -> DataFrame:
        side = lambda c: self.classes.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
        full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")
        return self.scratch.store(full.mapInArrow(_likely(float(self.similarity)), "a long, b long"), "likely")

    def _open(self, crowd: DataFrame, groups: DataFrame, nearest: bool) -> DataFrame:
        """Pairs of different components that share a band, less those with its leader.

        For each class the one with the highest estimate in its block, or all that are verified.
        """
        named = crowd.where("size > 2").join(groups.withColumnRenamed("node", "cid"), "cid", "left")
        named = named.withColumn("comp", F.coalesce("component", "cid"))
        open_bands = named.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y")
        named = self.scratch.store(named.where("cid != lead").join(open_bands.select("band"), "band").drop("lead", "n_l", "component", "size"), "open")
        kept = named.join(self.classes.select("cid", "sig"), "cid")
        if not nearest:
            sets = self._sets(named.select("cid").distinct())
            kept = kept.join(sets, "cid") if sets is not None else kept.withColumn("hashes", F.array().cast("array<long>"))
        # Rows of a band's largest component are never compared with each other: they lie in chunks behind the blocks
        # of the others and are copied for these blocks only, so copies grow with the rows that are left outside it.
        counts = named.groupBy("band", "comp").agg(F.count("*").alias("c"))
        bands = counts.groupBy("band").agg(F.max(F.struct("c", "comp")).alias("largest"), F.sum("c").alias("size"))
        bands = bands.where(F.col("size") > F.col("largest.c")).select(
            "band", F.col("largest.comp").alias("big"), F.ceil(F.col("largest.c") / BLOCK).cast("int").alias("chunks"),
            F.ceil((F.col("size") - F.col("largest.c")) / BLOCK).cast("int").alias("blocks"),
        )
        kept = kept.join(self.scratch.store(bands, "open-bands"), "band")
        is_big = F.col("comp") == F.col("big")
        own = F.when(is_big, F.col("blocks") + F.pmod(F.xxhash64("cid"), "chunks")).otherwise(F.pmod(F.xxhash64("cid"), "blocks")).cast("int")
        last = F.col("blocks") - 1 + F.when(is_big, 0).otherwise(F.col("chunks"))
        sides = kept.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        sides = sides.select(
            "band", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
            (F.col("own") > F.col("other")).cast("int").alias("side"), "cid", "comp", "n", "sig", *["hashes"][nearest:],
        )
        sides = sides.repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi", "cid")
        found = sides.mapInArrow(_open_blocks(self.similarity, nearest), "a long, b long")
        return self.scratch.store(found.distinct(), "open-pairs")

    def _sets(self, cids: DataFrame) -> DataFrame | None:
        """Full sets of at least these classes; those that were asked for earlier are not made again."""
        wanted = cids.join(self.sets.select("cid"), "cid", "left_anti") if self.sets is not None else cids
        wanted = self.scratch.store(wanted.join(self.classes, "cid").select("cid", "rep", "d1", "d2"), "wanted")
        if not wanted.isEmpty():
            # Rows of four numbers: up to this count they are sent to the texts, beyond it texts are shuffled.
            side = F.broadcast(wanted) if wanted.count() <= MOST_SENT else wanted
            texts = self.docs.join(side, F.col("rep") == F.col("doc_id")).select("cid", "d1", "d2", "text")
            new = texts.mapInArrow(_own_sets(self.width), "cid long, hashes array<long>").dropDuplicates(["cid"])
            new = self.scratch.store(new, "sets")
            self.sets = new if self.sets is None else self.sets.unionByName(new)
        return self.sets

    def _links(self, pairs: DataFrame) -> DataFrame:
        """The pairs that hold on the full sets."""
        sets = self._sets(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct())
        if sets is None:
            return pairs
        side = lambda c: sets.select(F.col("cid").alias(c), F.col("hashes").alias(f"set_{c}"))
        full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
        return full.mapInArrow(_verified(self.similarity), "a long, b long")

    def _labelled(self, rows: DataFrame, groups: DataFrame) -> DataFrame:
        named = self.classes.join(groups.withColumnRenamed("node", "cid"), "cid", "left")
        named = named.select("d1", "d2", "rep", F.coalesce("component", "cid").alias("component"))
        named = self.scratch.store(named, "class-components")
        least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
        class_of = self.scratch.store(named.join(least, "component").select("d1", "d2", "component_id"), "class-labels")
        out = rows.drop("sig").join(class_of, ["d1", "d2"], "left")
        found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        return out.select(
            "doc_id", F.col("n").alias("n_shingles"), found.alias("component_id"),
            F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"),
        )


def near_duplicates(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """See :class:`NearDuplicates`."""
    return NearDuplicates(docs, width, similarity).result()


def without_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest ``doc_id``.

    Rows without ``doc_id`` and documents without words stay. Of several rows that share a kept
    ``doc_id`` one stays.
    """
    scratch = Scratch(docs.sparkSession, "without-copies")
    named = docs.withColumn("__near_id", F.col("doc_id").cast("long"))
    gone = near_duplicates(docs, width, similarity).where("NOT kept").select(F.col("doc_id").alias("__near_id")).distinct()
    gone = scratch.store(gone, "gone")
    repeated = scratch.store(named.groupBy("__near_id").count().where("__near_id IS NOT NULL AND count > 1").select("__near_id"), "repeated")
    kept = named.join(gone, "__near_id", "left_anti")
    one = kept.join(repeated, "__near_id", "left_semi").dropDuplicates(["__near_id"])
    return kept.join(repeated, "__near_id", "left_anti").unionByName(one).select(docs.columns)
