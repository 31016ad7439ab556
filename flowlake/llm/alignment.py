"""Alignment of two tokenizers over whole texts, with corpus-wide counts of the linked id pairs.

Texts are cut where neither tokenizer can reach across: before a space or a line feed that follows something
solid. Each distinct part is encoded once per task. A task collects records (pair, document, how often), sorts
them by pair with the second tokenizer's id first, and hands them on as runs: blocks of sorted records,
radix-partitioned by the leading id and compressed with zstd, so no record is a Spark row.

Runs of a radix partition are merged with a heap of block cursors as Spark's external sort delivers the blocks
by their first pair. The first merge counts each pair; the counts stand in the order of the second tokenizer's
ids, so each id's highest is at hand. The second merge has the counted pairs as one more run: records meet
their pair's count in lockstep, and what they contribute streams back to the documents as sums.

A partition with too many bytes is salted by the task that wrote the run; a pair's partial counts are then
added up, and its counts are sent to each of the salted partitions.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm import textops as X
from flowlake.llm.scratch import Scratch

#: Radix partitions of the second tokenizer's ids, and the compressed bytes from which one is salted.
RADIX = 16
GROUP_BYTES = 16 << 20
#: Records of a block, of a run before it is sorted, and in memory before a merge step.
BLOCK, _RUN, _MERGED = 1 << 15, 3 << 20, 1 << 20
#: Bytes of text looked at together; distinct parts that a task remembers.
_TOGETHER, _REMEMBERED = 1 << 21, 1 << 20
_A_BITS = 32

_SOLID = np.ones(256, dtype=bool)
_SOLID[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = False
#: Characters that the first tokenizer may hold for white space end in these ways in UTF-8.
_SPACE_LEADS = (0xE1, 0xE2, 0xE3)
_MARK = "▁"


def byte_decoder() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, and the bytes that each of their ids stands for."""

    def __init__(self, byte_bpe: bytes, pieces: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        decoder = byte_decoder()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(decoder[c] for c in token) if all(c in decoder for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or _MARK in p.lstrip(_MARK) for p in names):
            raise ValueError("a piece of this vocabulary reaches across spaces or line feeds")
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(names)
        ]
        self.lead = len(self.b.encode("\n"))
        self.a_len = np.array([len(x) for x in self.a_bytes])
        self.b_len = np.array([len(x) for x in self.b_bytes])
        # Every id as text with what may follow it: inside its side, at the side's end.
        self.a_text = [(b"%d," % i, b"%d|" % i) for i in range(len(self.a_bytes))]
        self.b_text = [(b"%d," % i, b"%d;" % i) for i in range(len(self.b_bytes))]

    def encoded(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both tokenizers for parts that stand one behind the other; None if their bytes differ."""
        text = b"".join(parts).decode()
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode("\n" + text, num_threads=1)[self.lead :]
        raw = text.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


@lru_cache(maxsize=2)
def tokenizer_pair(byte_bpe: bytes, pieces: bytes) -> Pair:
    return Pair(byte_bpe, pieces)


def cut(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer of a space and the text for each non-empty text; starts and ends of its parts; parts per text."""
    put = [b" " + bytes(t) if len(t) else b"" for t in texts]
    buf = np.frombuffer(b"".join(put), dtype=np.uint8)
    bounds = np.cumsum([len(p) for p in put], dtype=np.int64)
    start = (buf == 32) | (buf == 10)
    solid = _SOLID[buf]
    for back in (2, 3):  # a character of two or three bytes may be white space too
        lead = np.isin(buf[: len(buf) - back + 1], _SPACE_LEADS) if back == 3 else buf[: len(buf) - 1] == 0xC2
        if len(lead):
            solid[back - 1 :] &= ~lead
    start[1:] &= solid[:-1]
    first = np.append(0, bounds[:-1])
    start[first[first < bounds]] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(buf)) if len(starts) else starts
    return buf, starts, ends, np.diff(np.searchsorted(starts, bounds), prepend=0)


class _Parts:
    """What is known of the parts a task has met."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.place, self.text = {}, []
        self.sizes, self.links, self.n_links = [], [], 0

    def _add(self, hashes: list[int], parts: list[bytes]) -> None:
        found = self.pair.encoded(parts)
        if found is None:
            if len(parts) > 1:  # the one that differs is found by halves
                half = len(parts) // 2
                self._add(hashes[:half], parts[:half])
                self._add(hashes[half:], parts[half:])
            else:
                self._known(hashes, [b""], np.array([[0, 0, 0, 0]]), np.zeros(0, np.int64))
            return
        a, b = found
        p = self.pair
        a_end, b_end = np.cumsum(p.a_len[a]), np.cumsum(p.b_len[b])
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        links = (b[np.searchsorted(b_end, common)] << _A_BITS) | a[np.searchsorted(a_end, common)]
        # Group by group the first tokenizer's ids, then the second's; the last of a side has another follower.
        group = np.concatenate([2 * np.searchsorted(common, a_end), 2 * np.searchsorted(common, b_end) + 1])
        last = np.concatenate([common[group[: len(a)] // 2] == a_end, common[group[len(a) :] // 2] == b_end])
        order = np.argsort(group, kind="stable")
        ids = np.concatenate([a, b])[order].tolist()
        words = [
            (p.a_text if i < len(a) else p.b_text)[x][at_end]
            for i, x, at_end in zip(order.tolist(), ids, last[order].astype(int).tolist(), strict=True)
        ]
        bounds = np.cumsum([len(x) for x in parts])
        upto = [np.searchsorted(e, bounds, "right") for e in (a_end, b_end, common)]
        if any(not np.array_equal(e[u - 1], bounds) for e, u in zip((a_end, b_end, common), upto, strict=True)):
            raise ValueError("a token reaches across two parts")
        n_a, n_b, n_links = (np.diff(u, prepend=0) for u in upto)
        at = [0, *(upto[0] + upto[1]).tolist()]
        text = [b"".join(words[x:y])[:-1] for x, y in zip(at, at[1:], strict=False)]
        self._known(hashes, text, np.stack([n_a, n_b, n_links, np.ones(len(parts), np.int64)], axis=1), links)

    def _known(self, hashes, text, sizes, links):
        for h in hashes:
            self.place[h] = len(self.place)
        self.text += text
        self.sizes.append(sizes)
        self.links.append(links)

    def numbers(self, hashes: np.ndarray, parts: Callable[[int], bytes]) -> np.ndarray:
        """A number for each distinct part."""
        listed = hashes.tolist()
        new = [i for i, h in enumerate(listed) if h not in self.place]
        alone, together = [], []
        for i in new:  # the mark itself, and white space at an end, are looked at one by one
            part = parts(i)
            joined = _SOLID[part[-1]] and part[-1] < 0x80 and _MARK.encode() not in part
            (together if joined else alone).append((listed[i], part))
        for i in range(0, len(together), 20_000):
            h, p = zip(*together[i : i + 20_000], strict=True)
            self._add(list(h), list(p))
        for h, p in alone:
            self._add([h], [p])
        if new:
            self.sizes, self.links = [np.concatenate(self.sizes)], [np.concatenate(self.links)]
        return np.array([self.place[h] for h in listed], dtype=np.int64)

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = self.sizes[0]
        return sizes, np.cumsum(sizes[:, 2]) - sizes[:, 2], self.links[0]


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit values: the first as differences, bytes of equal weight side by side, zstd."""
    columns = [np.diff(columns[0], prepend=0), *columns[1:]]
    raw = b"".join(c.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpacked(data: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    columns = [np.ascontiguousarray(c.T).view("<i8").ravel() for c in raw.reshape(-1, 8, n)]
    return [np.cumsum(columns[0]), *columns[1:]]


_BLOCKS = "radix int, run long, first long, n int, data binary"


def _blocks(columns: list[np.ndarray], radix: np.ndarray, run: int) -> Iterator[tuple]:
    """Sorted records as rows of ``_BLOCKS``; no block reaches across radix partitions."""
    edges = np.flatnonzero(np.diff(radix)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(radix)], strict=True):
        for x in range(a, b, BLOCK):
            part = [c[x : min(x + BLOCK, b)] for c in columns]
            yield int(radix[x]), run, int(part[0][0]), len(part[0]), _packed(part)


class _Records:
    """Records of a task that wait to be sorted into a run."""

    def __init__(self, radix_width: int):
        self.width, self.held, self.n = radix_width, [], 0

    def add(self, *columns: np.ndarray):
        self.held.append(columns)
        self.n += len(columns[0])

    def run(self, number: int) -> list[tuple]:
        if not self.n:
            return []
        columns = [np.concatenate(c) for c in zip(*self.held, strict=True)]
        order = np.argsort(columns[0], kind="stable")
        columns = [c[order] for c in columns]
        self.held, self.n = [], 0
        return list(_blocks(columns, (columns[0] >> _A_BITS) // self.width, number))


def _aligned(kept: list[str], kinds: list, byte_bpe, pieces) -> Callable:
    """The rows of ``docs`` with what is known inside one text, then blocks of records."""
    names = [*kept, "uid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *[f.split()[0] for f in _BLOCKS.split(", ")]]
    types = [*kinds, *[pa.int64()] * 5, pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def batch_of(columns: dict, n: int) -> pa.RecordBatch:
        return pa.record_batch(
            [columns[c].cast(t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names
        )

    def run(batches):
        pair = tokenizer_pair(byte_bpe.value, pieces.value)
        records, parts = _Records(-(-len(pair.b_bytes) // RADIX)), _Parts(pair)
        base, n_docs, runs = TaskContext.get().partitionId() << 33, 0, 0

        def handed_on():
            nonlocal runs
            made, runs = records.run(base + runs), runs + 1
            for x in range(0, len(made), 64):
                some = zip(*made[x : x + 64], strict=True)
                arrays = dict(zip(names[-5:], map(pa.array, some), strict=True))
                yield batch_of(arrays, len(made[x : x + 64]))

        for batch in batches:
            texts = X.raw_texts(batch.column(batch.schema.get_field_index("text")))
            found, digests = [], []
            for x, y in X.pieces(texts, _TOGETHER):
                if len(parts.text) > _REMEMBERED:
                    parts = _Parts(pair)
                buf, starts, ends, counts = cut(texts[x:y])
                hashes, first, back = np.unique(X.span_hashes(buf, starts, ends, X.BYTE_CODES), return_index=True, return_inverse=True)
                if not len(hashes):
                    found.append(np.zeros((y - x, 3), np.int64))
                    digests += [""] * (y - x)
                    continue
                e = parts.numbers(hashes, lambda i: buf[starts[first[i]] : ends[first[i]]].tobytes())[back]
                sizes, link_start, links = parts.flat()
                doc = np.repeat(np.arange(y - x), counts)
                sound = (counts > 0) & (np.bincount(doc, sizes[e, 3] == 0, y - x) == 0)
                sums = np.stack([np.bincount(doc, sizes[e, i], y - x).astype(np.int64) for i in range(3)], axis=1)
                found.append(np.where(sound[:, None], sums, 0))
                words, at = list(map(parts.text.__getitem__, e.tolist())), np.append(0, np.cumsum(counts)).tolist()
                for i, ok in enumerate(sound.tolist()):
                    digests.append(hashlib.sha256(b";".join(words[at[i] : at[i + 1]])).hexdigest() if ok else "")
                inside = sound[doc]
                e, doc = e[inside], doc[inside]
                n = sizes[e, 2]
                where = np.repeat(link_start[e] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                pairs, back = np.unique(links[where], return_inverse=True)  # numbered, so that one sort finds a text's pairs
                key, times = np.unique(np.repeat(doc, n) * max(len(pairs), 1) + back, return_counts=True)
                records.add(pairs[key % max(len(pairs), 1)] if len(pairs) else pairs, base + n_docs + x + key // max(len(pairs), 1), times)
                if records.n > _RUN:
                    yield from handed_on()
            if texts:
                sums = np.concatenate(found)
                columns = {c: batch.column(batch.schema.get_field_index(c)) for c in kept}
                columns |= {"uid": pa.array(base + n_docs + np.arange(len(texts))), "groups_sha256": pa.array(digests)}
                columns |= {c: pa.array(sums[:, i]) for c, i in (("n_a", 0), ("n_b", 1), ("n_groups", 2), ("n_links", 2))}
                yield batch_of(columns, len(texts))
                n_docs += len(texts)
        yield from handed_on()

    return run


def _merged(rows: Iterator[tuple]) -> Iterator[tuple]:
    """k-way merge of one group's blocks, which come by their first pair: (pairs, docs, times, counted) steps.

    A heap holds a cursor per open block. Whatever is not beyond the latest block's first pair can be followed by
    equal pairs only, so it is merged; what is open after that is at most one block per run. ``counted`` has the
    counted pairs (pair, count, best) up to there; the blocks without documents bring them.
    """
    heap, waiting, number = [], 0, 0
    counted = [np.zeros(0, np.int64)] * 3

    def step(upto: int):
        nonlocal waiting
        taken = []
        while heap and heap[0][0] <= upto:
            _, i, columns = heapq.heappop(heap)
            end = int(np.searchsorted(columns[0], upto, "right"))
            taken.append([c[:end] for c in columns])
            waiting -= end
            if end < len(columns[0]):
                rest = [c[end:] for c in columns]
                heapq.heappush(heap, (int(rest[0][0]), i, rest))
        if taken:
            pairs, docs, times = (np.concatenate(c) for c in zip(*taken, strict=True))
            order = np.argsort(pairs, kind="stable")
            return pairs[order], docs[order], times[order], counted

    for kind, first, n, data in rows:
        columns = _unpacked(data, n)
        if kind == 0:
            keep = int(np.searchsorted(counted[0], min(heap[0][0] if heap else first, first)))
            counted = [np.concatenate([old[keep:], new]) for old, new in zip(counted, columns, strict=True)]
            continue
        heapq.heappush(heap, (first, number, columns))
        number, waiting = number + 1, waiting + n
        if waiting > _MERGED:
            made = step(first)
            if made:
                yield made
    made = step(np.iinfo(np.int64).max)
    if made:
        yield made


def _by_group(batches) -> Iterator[Iterator[tuple]]:
    """The rows radix, salt, kind, first, n, data of sorted batches, group by group."""
    from itertools import groupby

    def rows():
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:5]]
            for i, head in enumerate(zip(*columns, strict=True)):
                yield *head, batch.column(5)[i].as_py()

    for _, group in groupby(rows(), key=lambda r: r[:2]):
        yield (r[2:] for r in group)


def _sums(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Sums of the values by sorted key."""
    if not len(keys):
        return [keys, *values]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return [keys[first], *(np.add.reduceat(v, first) for v in values)]


def _pair_counts(batches):
    for group in _by_group(batches):
        for pairs, _, times, _ in _merged(group):
            pairs, n = _sums(pairs, times)
            yield pa.record_batch([pa.array(pairs >> _A_BITS), pa.array(pairs & ((1 << _A_BITS) - 1)), pa.array(n)], ["b", "a", "n"])


def _contributions(batches):
    """Per document of a group the links with the highest count of their second id, and the sum of all counts."""

    def rows(held):
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        order = np.argsort(columns[0], kind="stable")
        return _sums(*(c[order] for c in columns))

    for group in _by_group(batches):
        held, n = [], 0
        for pairs, docs, times, (known, count, best) in _merged(group):
            at = np.searchsorted(known, pairs)
            held.append(rows([[docs, times * best[at], times * count[at]]]))
            n += len(held[-1][0])
            if n > _MERGED:
                held = [rows(held)]
                n = len(held[0][0])
                if n > _MERGED // 2:
                    yield pa.record_batch([pa.array(c) for c in held[0]], ["uid", "n_best", "count_sum"])
                    held, n = [], 0
        if held:
            yield pa.record_batch([pa.array(c) for c in rows(held)], ["uid", "n_best", "count_sum"])


def _counts_as_blocks(batches):
    """b, a, n, best in order of (radix, b, a) -> blocks with the counted pairs."""
    for batch in batches:
        if len(batch):
            radix, b, a, n, best = (c.to_numpy() for c in batch.columns)
            rows = list(_blocks([(b << _A_BITS) | a, n, best], radix, -1))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], [f.split()[0] for f in _BLOCKS.split(", ")])


class Alignment:
    """Both tokenizers' tokens of every text, cut at the byte offsets where both end.

    ``byte_bpe`` is the path of a byte-level ``tokenizers`` file, ``pieces`` that of a sentencepiece model; the
    driver reads them. A text is encoded with a space before it, special strings are plain text. Texts that are
    null or empty, or whose joined bytes differ from the text's (the piece model's own space mark inside a text),
    have no tokens: zeros and an empty digest. Repeated rows and rows without id each count. Columns of ``docs``
    with the names of the results are replaced, those named ``uid, radix, run, first, n, data`` are left out. Texts are never cut short; a text's longest part bounds memory.
    """

    def __init__(self, docs: DataFrame, byte_bpe: str, pieces: str):
        self.spark = docs.sparkSession
        self.scratch = Scratch(self.spark, "alignment")
        made = ["uid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "radix", "run", "first", "n", "data"]
        docs = docs.drop(*made).withColumn("text", F.col("text").cast("string"))
        kept = [c for c in docs.columns if c != "text"]
        files = []
        for path in (byte_bpe, pieces):
            with open(path, "rb") as f:
                files.append(self.spark.sparkContext.broadcast(f.read()))
        with open(pieces, "rb") as f:
            import sentencepiece

            self.width = -(-sentencepiece.SentencePieceProcessor(model_proto=f.read()).get_piece_size() // RADIX)
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(docs.schema[c].dataType) for c in kept]
        types = dict(docs.dtypes)
        schema = ", ".join([*[f"`{c}` {types[c]}" for c in kept], "uid long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string", _BLOCKS])
        rows = docs.mapInArrow(_aligned(kept, kinds, *files), schema)
        self.rows, self.kept = self.scratch.store(rows, "rows-and-runs"), kept

    def _groups(self) -> tuple[DataFrame, DataFrame]:
        """The blocks with their salt, and how many salts each radix partition has: one row per radix."""
        blocks = self.rows.where("data IS NOT NULL").select("radix", "run", "first", "n", "data")
        size = blocks.groupBy("radix").agg(F.sum(F.length("data")).alias("bytes"))
        salts = F.broadcast(size.select("radix", F.ceil(F.col("bytes") / GROUP_BYTES).cast("int").alias("salts")))
        salt = F.pmod(F.shiftright("run", 33), F.col("salts")).cast("int")
        return blocks.join(salts, "radix").select("radix", salt.alias("salt"), F.lit(1).alias("kind"), "first", "n", "data"), salts

    def pair_counts(self) -> DataFrame:
        """``b, a, n, best``: how many links of all texts hold the pair; whether that is the highest of ``b``."""
        blocks, _ = self._groups()
        lined = blocks.repartition("radix", "salt").sortWithinPartitions("radix", "salt", "first")
        found = lined.mapInArrow(_pair_counts, "b long, a long, n long").groupBy("b", "a").agg(F.sum("n").alias("n"))
        # An id of one vocabulary meets at most the ids of the other: a window is bounded by its size.
        return found.withColumn("best", (F.col("n") == F.max("n").over(Window.partitionBy("b"))).cast("long"))

    def documents(self) -> DataFrame:
        """The columns of ``docs`` without ``text``, ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
        counts = self.scratch.store(self.pair_counts(), "pairs")
        blocks, salts = self._groups()
        radix = F.floor(F.col("b") / self.width).cast("int")
        packed = counts.select(radix.alias("radix"), "b", "a", "n", "best").repartition("radix").sortWithinPartitions("radix", "b", "a")
        packed = packed.mapInArrow(_counts_as_blocks, _BLOCKS).join(salts, "radix")
        packed = packed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        both = packed.select("radix", "salt", F.lit(0).alias("kind"), "first", "n", "data").unionByName(blocks)
        lined = both.repartition("radix", "salt").sortWithinPartitions("radix", "salt", "first", "kind")
        back = lined.mapInArrow(_contributions, "uid long, n_best long, count_sum long")
        back = back.groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        rows = self.rows.where("uid IS NOT NULL").drop("radix", "run", "first", "n", "data").join(back, "uid", "left")
        sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
        return rows.select(*self.kept, "n_a", "n_b", "n_groups", "n_links", *sums, "groups_sha256")
