"""Phrase collocations from count streams in prefix order and suffix order.

Phrases are counted order by order: a phrase can only be frequent if all its parts are, so the text's phrases of
the next order are counted where their words (then their pairs) may be frequent. A bit table of fixed size tells
which may be; what it lets through too much is counted exactly and goes by its count.

The frequent phrases of all orders form one stream, kept twice: sorted by words from the front and by words from
the back. In the first a phrase follows its own beginnings, so one pass in lockstep over the orders gives each
phrase the counts of all its first parts, and gives each phrase the count of its extensions by one word at the
right; the second does the same for last parts and extensions at the left. Nothing is looked up by hash. The
streams are cut into ranges of equal size wherever the words fall; the beginnings of a range's first phrase,
one per order, are handed to its task, so a word that begins a third of all phrases is shared out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm import bags
from flowlake.llm import textops as X
from flowlake.llm.bitset import bitset, present
from flowlake.llm.scratch import Scratch

#: Language of texts that have none.
NO_LANG = "und"
#: Bytes of text looked at together, and distinct phrases that a task adds up before it hands them on.
_TOGETHER, _HELD = 1 << 21, 1 << 20
_ROWS = 1 << 17

# What each byte is: 0 part of a word, 1 blank, 2 the end of a piece.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?") + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Words:
    """The words of a few texts: hash, piece, and their bytes in ``clean``, each with one space behind it."""

    def __init__(self, texts: list, salts: np.ndarray):
        buf = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)]
        kind = _KIND[buf]
        solid = kind == 0
        edge = np.diff(solid.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text = np.searchsorted(np.cumsum(size), starts, "right")
        self.hashes = X.span_hashes(buf, starts, ends, X.BYTE_CODES)
        self.salts = salts[self.text]
        length = ends - starts
        self.ends = np.cumsum(length + 1) - 1
        self.starts = self.ends - length
        self.clean = np.full(int(length.sum()) + len(length), 32, dtype=np.uint8)
        inside = np.ones(len(self.clean), dtype=bool)
        inside[self.ends] = False
        self.clean[inside] = buf[solid]

    def grams(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each order its number, the keys, and which stay inside a piece; item i starts at word i."""
        key = X.mixed(self.hashes ^ self.salts)
        inside = np.ones(len(key), dtype=bool)
        yield 1, key, inside
        for order in range(2, most + 1):
            key = X.mixed(key[:-1] + X.mixed(self.hashes[order - 1 :], order))
            inside = inside[:-1] & (self.piece[: len(key)] == self.piece[order - 1 :])
            yield order, key, inside

    def bytes_of(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The words from ``first`` to ``last`` with single spaces, as a binary column."""
        start, end = self.starts[first], self.ends[last]
        offsets = np.append(0, np.cumsum(end - start))
        at = np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])
        data = pa.py_buffer(self.clean[at].tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), data])


def _salts(langs: list[str]) -> np.ndarray:
    return X.mixed(bags.token_hash([lang.encode() for lang in langs]), 0x1A)


class _Sums:
    """Distinct phrases with their counts; handed on when there are too many."""

    def __init__(self):
        self.keys, self.counts, self.langs, self.phrases, self.n = [], [], [], [], 0

    def add(self, keys, counts, langs, phrases: pa.Array):
        for held, new in ((self.keys, keys), (self.counts, counts), (self.langs, langs), (self.phrases, phrases)):
            held.append(new)
        self.n += len(keys)
        if self.n > 2 * _HELD:
            self._merge()

    def _merge(self):
        if self.n:
            keys, first, back = np.unique(np.concatenate(self.keys), return_index=True, return_inverse=True)
            counts = np.bincount(back, np.concatenate(self.counts), len(keys)).astype(np.int64)
            phrases = pa.chunked_array(self.phrases).take(pa.array(first)).combine_chunks()
            self.keys, self.counts, self.langs = [keys], [counts], [np.concatenate(self.langs)[first]]
            self.phrases, self.n = [phrases if isinstance(phrases, pa.Array) else phrases.chunk(0)], len(keys)

    def full(self) -> bool:
        return self.n > _HELD

    def rows(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        self._merge()
        if self.n:
            langs = pa.DictionaryArray.from_arrays(pa.array(self.langs[0].astype(np.int32)), pa.array(names)).cast(pa.string())
            phrases, counts = self.phrases[0], pa.array(self.counts[0])
            for a in range(0, self.n, _ROWS):
                cut = [langs.slice(a, _ROWS), phrases.slice(a, _ROWS).cast(pa.binary()).cast(pa.string()), counts.slice(a, _ROWS)]
                yield pa.record_batch(cut, ["lang", "phrase", "n"])
        self.__init__()


def _counted(orders: range, gates: dict) -> Callable:
    """lang, text -> phrases of ``orders`` with partial counts, and each language's words as a null phrase.

    ``gates`` has bit tables by order: a phrase is counted if all its parts of that order are in the table.
    """

    def run(batches):
        names, codes, sums = [], {}, _Sums()
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), X.raw_texts(batch.column(1))
            for lang in langs:
                if lang not in codes:
                    codes[lang] = len(names)
                    names.append(lang)
            code = np.fromiter((codes[lang] for lang in langs), np.int64, len(langs))
            salts = _salts(names)
            for a, b in X.pieces(texts, _TOGETHER):
                w = _Words(texts[a:b], salts[code[a:b]])
                if not len(w.hashes):
                    continue
                word_lang, open_parts = code[a:b][w.text], {}
                if 1 in orders:
                    total = np.bincount(word_lang, minlength=len(names))
                    seen = np.flatnonzero(total)
                    sums.add(salts[seen], total[seen], seen, pa.nulls(len(seen), pa.large_binary()))
                found = []
                for order, key, inside in w.grams(orders[-1]):
                    for width, allowed in open_parts.items():  # each part of the gate's order must be open
                        inside = inside & np.logical_and.reduce([allowed[k : k + len(key)] for k in range(order - width + 1)])
                    if order in gates:
                        open_parts[order] = inside & present(gates[order].value, key)
                    if order in orders:
                        at = np.flatnonzero(inside)
                        found.append((key[at], at, at + order - 1))
                key, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
                if len(key):
                    key, place, n = np.unique(key, return_index=True, return_counts=True)
                    sums.add(key, n, word_lang[first[place]], w.bytes_of(first[place], last[place]))
                if sums.full():
                    yield from sums.rows(names)
        yield from sums.rows(names)

    return run


def _keys(order: int) -> Callable:
    """lang, phrase -> the key that the phrase has in texts."""

    def run(batches):
        for batch in batches:
            if len(batch):
                names = batch.column(0).to_pylist()
                langs = sorted(set(names))
                salts = dict(zip(langs, _salts(langs).tolist(), strict=True))
                w = _Words(X.raw_texts(batch.column(1)), np.array([salts[x] for x in names], dtype=np.uint64))
                for n, key, _ in w.grams(order):
                    if n == order:
                        yield pa.record_batch([pa.array(X.signed(key[::order] if order > 1 else key))], ["key"])

    return run


_SIDE = "lang string, key array<string>, n long, parts array<long>, covered boolean"


def _in_lockstep(most: int, cover: int, edges: dict) -> Callable:
    """part, lang, key, n in sorted order -> phrases of two words or more with the counts of their beginnings.

    ``edges`` has, by part, the beginnings (key, n) of its first phrase. ``covered`` tells whether an extension by
    one word reaches ``cover`` percent of the phrase; where that is seen only in a later batch or part, a row
    without counts brings it.
    """

    def run(batches):
        part, stack = None, []
        for batch in batches:
            parts = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(parts)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(parts)], strict=True):
                if a == b:
                    continue
                rows = batch.slice(a, b - a)
                if parts[a] != part:
                    part, stack = parts[a], edges.get(int(parts[a]), [])
                held, keys = len(stack), rows.column(2)
                order = np.concatenate([[len(k) for _, k, _ in stack], keys.value_lengths().to_numpy()]).astype(np.int64)
                n = np.concatenate([[c for _, _, c in stack], rows.column(3).to_numpy()]).astype(np.int64)
                place = np.arange(len(order))
                last = [np.maximum.accumulate(np.where(order == k, place, -1)) for k in range(1, most + 1)]
                covered = np.zeros(len(order), dtype=bool)
                for k in range(3, most + 1):
                    child = np.flatnonzero((order == k) & (place >= held))
                    parent = last[k - 2][child]
                    close = [100 * int(x) >= cover * int(y) for x, y in zip(n[child], n[parent], strict=True)]
                    covered[parent[np.array(close, dtype=bool)]] = True
                begun = np.stack([n[at] for at in last[: most - 1]], axis=1)[held:]
                own = np.flatnonzero(order[held:] >= 2)
                lists = [begun[i, : order[held + i] - 1] for i in own.tolist()]
                if len(own):
                    taken = rows.take(pa.array(own))
                    yield pa.record_batch(
                        [taken.column(1), taken.column(2), taken.column(3), X.long_lists(lists), pa.array(covered[held:][own])],
                        ["lang", "key", "n", "parts", "covered"],
                    )
                late = [stack[i] for i in np.flatnonzero(covered[:held]).tolist()]
                if late:
                    yield pa.RecordBatch.from_pylist(
                        [{"lang": g, "key": k, "n": None, "parts": None, "covered": True} for g, k, _ in late],
                        pa.schema([("lang", pa.string()), ("key", pa.list_(pa.string())), ("n", pa.int64()), ("parts", pa.list_(pa.int64())), ("covered", pa.bool_())]),
                    )
                tops, deepest = [int(at[-1]) for at in last], int(order[-1])
                stack = [
                    stack[i] if i < held else (rows.column(1)[i - held].as_py(), keys[i - held].as_py(), int(n[i]))
                    for i in tops[:deepest]
                ]

    return run


class Collocations:
    """Phrases of 2 to ``most_words`` words that occur ``least`` times, per language.

    ``docs`` needs ``text`` and ``lang``; a null text is empty and a null language is ``und``. Only A-Z are
    lower-cased. Other columns are not looked at, repeated rows count each time, texts of any length are counted
    whole, and an empty table gives an empty result.
    """

    def __init__(self, docs: DataFrame, most_words: int = 5, least: int = 100, cover: int = 100):
        if most_words < 2:
            raise ValueError("a phrase has two words at least")
        self.spark, self.most, self.least, self.cover = docs.sparkSession, most_words, least, cover
        self.scratch = Scratch(self.spark, "collocations")
        lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG))
        self.docs = docs.select(lang.alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def _count(self, orders: range, gates: dict) -> DataFrame:
        found = self.docs.mapInArrow(_counted(orders, gates), "lang string, phrase string, n long")
        sums = found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        return self.scratch.store(sums.where((F.col("n") >= self.least) | F.col("phrase").isNull()), f"grams-{orders[-1]}")

    def _gate(self, grams: DataFrame, order: int):
        keys = grams.where(F.col("phrase").isNotNull()).select("lang", "phrase").mapInArrow(_keys(order), "key long")
        return bitset(keys, F.col("key"))

    def grams(self) -> tuple[DataFrame, DataFrame]:
        """``lang, words, n`` of all frequent phrases, single words too; and ``lang, total`` words."""
        words = self._count(range(1, 2), {})
        totals = words.where("phrase IS NULL").select("lang", F.col("n").alias("total"))
        tables, gates = [words.where("phrase IS NOT NULL")], {1: self._gate(words, 1)}
        tables.append(self._count(range(2, 3), gates))
        if self.most > 2:
            tables.append(self._count(range(3, self.most + 1), gates | {2: self._gate(tables[1], 2)}))
        every = tables[0]
        for table in tables[1:]:
            every = every.unionByName(table)
        return every.select("lang", F.split("phrase", " ").alias("words"), "n"), totals

    def _side(self, grams: DataFrame, key: F.Column, name: str) -> DataFrame:
        """The stream sorted by ``key``, passed through once in lockstep."""
        ordered = grams.select("lang", key.alias("key"), "n").repartitionByRange("lang", "key").sortWithinPartitions("lang", "key")
        table = self.scratch.store(ordered.withColumn("part", F.spark_partition_id()), name)
        # One row per part, then at most one per part and order: bounded by the number of partitions.
        firsts = table.groupBy("part").agg(F.min(F.struct("lang", "key")).alias("f")).select("part", "f.*")
        begins = firsts.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(self.most - 1)))).where(F.col("k") < F.size("key"))
        begins = F.broadcast(begins.select("part", "k", "lang", F.slice("key", 1, F.col("k")).alias("key")))
        edges: dict[int, list] = {}
        for r in table.select("lang", "key", "n").join(begins, ["lang", "key"]).orderBy("part", "k").collect():
            edges.setdefault(r.part, []).append((r.lang, list(r.key), r.n))
        lined = table.repartition("part").sortWithinPartitions("part", "lang", "key").select("part", "lang", "key", "n")
        return lined.mapInArrow(_in_lockstep(self.most, self.cover, edges), _SIDE)

    def phrases(self) -> DataFrame:
        """``lang, words, a, l, r, n, score, covered``: one row per frequent phrase of two words or more.

        ``a, l, r`` are the counts of the phrase and of the two parts of its lowest-scoring cut (ties: the shortest
        first part), ``n`` the language's words, ``score`` floor(1000 a n / (l r)) of that cut; ``covered`` tells
        whether the words stand in a longer frequent phrase with at least ``cover`` percent of the count. A longer
        phrase counts no more than the extensions by one word that lead to it, so these decide.
        """
        grams, totals = self.grams()
        left = self._side(grams, F.col("words"), "prefix-order").withColumnRenamed("parts", "left")
        right = self._side(grams, F.reverse("words"), "suffix-order").withColumnRenamed("parts", "right")
        left = left.withColumn("right", F.lit(None).cast("array<long>"))
        right = right.withColumn("key", F.reverse("key")).withColumn("left", F.lit(None).cast("array<long>"))
        both = left.unionByName(right).groupBy("lang", "key")
        both = both.agg(F.max("n").alias("a"), F.max("left").alias("fl"), F.max("right").alias("fr"), F.max("covered").alias("covered"))
        cuts = F.expr(
            """transform(sequence(1, size(key) - 1), k -> struct(
                 (cast(1000 AS decimal(38,0)) * cast(a AS decimal(19,0)) * cast(total AS decimal(19,0)))
                   div (cast(fl[k - 1] AS decimal(19,0)) * cast(fr[size(key) - k - 1] AS decimal(19,0))) AS score,
                 k, fl[k - 1] AS l, fr[size(key) - k - 1] AS r))"""
        )
        found = both.join(totals, "lang").withColumn("cut", F.array_min(cuts))
        return found.select("lang", F.col("key").alias("words"), "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score", "covered")

    def top(self, k: int = 2_000) -> DataFrame:
        """The first ``k`` uncovered phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
        found = self.phrases().where(~F.col("covered")).withColumn("phrase", F.array_join("words", " "))
        by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
        return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
