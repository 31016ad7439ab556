"""Mixing sources to target weights with a low-discrepancy schedule of equal blocks of words.

1. Targets: every source has a weight; the wanted total is shared by weight, no source beyond ``most`` times
   its size, the excess shared again among the others.
2. Every source's documents are shuffled (by a seeded hash) and laid out on a line of words, which is cut into
   equal blocks; passing the end starts the line again.
3. Slot ``i`` of the schedule looks at the golden-ratio point frac(i * 0.618...) in the sources' cumulative
   shares. Slots are ranked within their source, and slot number k of a source takes its block k.

DataFrame functions only. Running sums take two levels (buckets, then rows of a bucket), so a source that
holds most of the rows is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.scratch import Scratch

WEIGHTS = (5, 2, 1)
#: Words per block, before a source's blocks are made equal.
BLOCK = 8_192
#: Documents per bucket of the shuffled line, and slots per chunk of the schedule.
_BUCKET = 4_096
#: Cells of the unit interval in which points find their source.
_CELLS = 1_024
#: 2^32 over the golden ratio, rounded to an odd number: points are exact multiples of 2^-32.
_GOLDEN = 2_654_435_769


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _before(value: str, *order: str) -> Column:
    """Sum of ``value`` over the earlier rows of a window."""
    return F.coalesce(F.sum(value).over(Window.partitionBy("src").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


class Mix:
    """A mix of ``docs`` (columns ``doc_id, text, source``).

    Sources are ranked by code point, null last; their weights repeat ``weights``. ``share`` times all words
    are wanted. The same rows give the same mix in every run. A null or empty text has no words and is
    taken never. Rows may lack an id or repeat one: each is a document of its own, and rows equal in id and
    text may change places. An empty table gives an empty mix.
    """

    def __init__(self, docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2, block: int = BLOCK, seed: int = 1):
        self.spark = docs.sparkSession
        self.scratch = Scratch(self.spark, "mix")
        self.weights, self.share, self.most, self.block = weights, share, most, block
        text = F.col("text").cast("string")
        rows = docs.select(
            F.monotonically_increasing_id().alias("uid") if "__uid" not in docs.columns else F.col("__uid").alias("uid"),
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            word_count(text).alias("size"), F.xxhash64(F.lit(seed), "doc_id", F.xxhash64(text)).alias("key"),
        )
        self.rows = self.scratch.store(rows, "sizes")
        self.sources = self._targets()
        self.slots = self._schedule()

    def _targets(self) -> DataFrame:
        """One row per source: ``src`` (its rank), size, target, and the whole words to take."""
        by_source = self.rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
        # From here on one row per source.
        rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
        w = F.element_at(F.array(*map(F.lit, self.weights)), (F.col("src") % len(self.weights) + 1).cast("int")).cast("double")
        s = by_source.withColumn("src", rank).withColumn("w", w)
        s = s.withColumn("cap", (F.col("source_size") * self.most).cast("double")).withColumn("full", F.col("cap") / F.col("w"))
        order = Window.orderBy("full", "src")
        earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
        everything = Window.orderBy("full", "src").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        wanted = F.sum("source_size").over(everything) * self.share
        level = (wanted - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("w").over(later)
        s = s.withColumn("level", level)
        # Sources are full up to the first whose share at the common level is within its cap.
        s = s.withColumn("cut", F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "src", "level"))).over(everything))
        target = F.when(F.struct("full", "src") < F.struct("cut.full", "cut.src"), F.col("cap")).otherwise(F.col("cut.level") * F.col("w"))
        s = s.withColumn("target", F.coalesce(F.least(target, "cap"), F.col("cap")))
        s = s.withColumn("take", F.least(F.round("target").cast("long"), F.col("source_size") * self.most))
        before = F.coalesce(F.sum("take").over(Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        s = s.withColumn("before", before).withColumn("total", F.sum("take").over(everything))
        return self.scratch.store(s.select("src", "source", "n_docs", "source_size", "target", "take", "before", "total"), "sources")

    def _schedule(self) -> DataFrame:
        """``slot, src, block, n_blocks``: which block of which source each slot takes."""
        total = self.sources.agg(F.max("total")).first()[0] or 0
        n = math.ceil(total / self.block)
        high = 1 << 32
        edge = lambda c: F.floor(c / F.col("total") * high).cast("long")
        live = self.sources.where("take > 0").withColumn("lo", edge(F.col("before"))).withColumn("hi", edge(F.col("before") + F.col("take")))
        width = high // _CELLS
        cells = live.withColumn("cell", F.explode(F.sequence((F.col("lo") / width).cast("long"), (F.col("hi") / width).cast("long"))))
        points = self.spark.range(n).select(F.col("id").alias("slot"), ((F.col("id") % high) * _GOLDEN % high).alias("x"))
        points = points.withColumn("cell", (F.col("x") / width).cast("long"))
        placed = points.join(cells.select("cell", "src", "lo", "hi"), "cell").where("lo <= x AND x < hi").select("slot", "src")
        # A source too small for a point of its own gets one slot at the end.
        missed = live.select("src").join(placed.select("src").distinct(), "src", "left_anti")
        placed = self.scratch.store(placed.unionByName(missed.select((F.lit(n) + F.col("src")).cast("long").alias("slot"), "src")), "points")
        placed = placed.withColumn("chunk", F.floor(F.col("slot") / _BUCKET))
        chunks = placed.groupBy("src", "chunk").agg(F.count("*").alias("k"))
        chunks = chunks.withColumn("earlier", _before("k", "chunk"))
        per_source = placed.groupBy("src").agg(F.count("*").alias("n_blocks"))
        inside = F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
        ranked = placed.withColumn("inside", inside).join(chunks.drop("k"), ["src", "chunk"]).join(F.broadcast(per_source), "src")
        return self.scratch.store(ranked.select("slot", "src", (F.col("earlier") + F.col("inside")).alias("block"), "n_blocks"), "schedule")

    def pieces(self) -> DataFrame:
        """``slot, uid, pass, first_word, words``: what each slot takes of each document."""
        n_blocks = self.slots.groupBy("src").agg(F.min("n_blocks").alias("n_blocks"))
        # One row per source, each of a few numbers.
        known = self.sources.join(n_blocks, "src").withColumnRenamed("source", "__s").drop("before", "total", "target")
        rows = self.rows.where("size > 0").join(F.broadcast(known), F.col("source").eqNullSafe(F.col("__s")))
        rows = rows.select("uid", "src", "size", "key", "doc_id", "source_size", "take", "n_blocks", (F.ceil(F.col("n_docs") / _BUCKET)).cast("long").alias("nb"))
        rows = rows.withColumn("bucket", F.pmod("key", "nb"))
        buckets = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
        buckets = buckets.withColumn("earlier", _before("words", "bucket")).drop("words")
        line = Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "size", "uid").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum("size").over(line), F.lit(0))
        rows = rows.withColumn("inside", inside).join(buckets, ["src", "bucket"])
        rows = rows.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(self.most - 1))))
        rows = rows.withColumn("from", F.col("earlier") + F.col("inside") + F.col("pass") * F.col("source_size"))
        rows = rows.withColumn("to", F.least(F.col("from") + F.col("size"), "take")).where("from < to")
        base, more = F.floor(F.col("take") / F.col("n_blocks")), F.col("take") % F.col("n_blocks")
        rows = rows.withColumn("base", base.cast("long")).withColumn("more", more)
        # The first ``more`` blocks have one word more than the others.
        wide = F.col("more") * (F.col("base") + 1)
        block_of = lambda p: F.when(p < wide, F.floor(p / (F.col("base") + 1))).otherwise(F.col("more") + F.floor((p - wide) / F.greatest("base", F.lit(1))))
        span = F.sequence(block_of(F.col("from")).cast("long"), block_of(F.col("to") - 1).cast("long"))
        rows = rows.withColumn("block", F.explode(span))
        start = F.col("block") * F.col("base") + F.least("block", "more")
        end = start + F.col("base") + (F.col("block") < F.col("more")).cast("long")
        begin, stop = F.greatest(start, "from"), F.least(end, "to")
        rows = rows.withColumn("words", stop - begin).withColumn("first_word", begin - F.col("from"))
        found = rows.join(self.slots.select("slot", "src", "block"), ["src", "block"])
        return found.select("slot", "uid", "pass", "first_word", "words")

    def documents(self) -> DataFrame:
        """``uid, doc_id, source, size, source_size, target, taken, passes, first_slot`` for every row of docs."""
        taken = self.pieces().groupBy("uid").agg(F.sum("words").alias("taken"), F.countDistinct("pass").alias("passes"), F.min("slot").alias("first_slot"))
        known = F.broadcast(self.sources.select(F.col("source").alias("__s"), "source_size", "target"))
        out = self.rows.join(known, F.col("source").eqNullSafe(F.col("__s"))).join(taken, "uid", "left")
        return out.select(
            "uid", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            F.coalesce("passes", F.lit(0)).alias("passes"), "first_slot",
        )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents the mix takes, once per pass, with ``pass, first_slot, taken`` (words of that pass)."""
    scratch = Scratch(docs.sparkSession, "mixed")
    plain = docs.drop("__uid", "pass", "first_slot", "taken")
    numbered = scratch.store(plain.withColumn("__uid", F.monotonically_increasing_id()), "documents")
    mix = Mix(numbered, **options)
    taken = mix.pieces().groupBy("uid", "pass").agg(F.min("slot").alias("first_slot"), F.sum("words").alias("taken"))
    return numbered.join(taken.withColumnRenamed("uid", "__uid"), "__uid").drop("__uid")
