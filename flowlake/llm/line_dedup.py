"""Removing repeated lines: an exact set-similarity join of lines by their words.

A line is what stands between line feeds; its set holds its distinct words. Lines with equal sets are one
class. Classes are joined when the Jaccard similarity of their sets is at least the threshold:

* words are ordered by rarity over all lines (words that occur in one line only first, frequent words by
  count last), so that the few words of a line's prefix are its rarest;
* prefix filter: two similar lines share a word of the longer line's prefix and the shorter line's (shorter)
  index prefix; words that occur in one line only are never sent;
* length, positional and parity filters;
* prefix rows, packed in blocks by a leading part of the word's hash, meet in one shuffle, and each task compares
  the lines of its words;
* of the earlier lines that a line may be similar to, each of its prefix words proposes the few nearest; these are
  verified on whole sets. A line found similar to an earlier one is settled, so a group of near copies costs a few
  pairs per line and not its square;
* lines that are not settled and have more possible partners are open: the words of their prefixes meet once more,
  and all their pairs are verified.

A line goes when an equal or similar line stands earlier, by document id, then position.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm import textops as X
from flowlake.llm.bitset import bitset, present
from flowlake.llm.scratch import Scratch

#: Frequent words whose exact counts order a line's words; rarer ones are ordered by hash before them.
RANKED_WORDS = 1 << 18
#: The counts are looked up by the leading bits of a word's hash (16 MB); words that share a place rank alike.
_RANK_BITS = 22
#: Classes with most copies, whose lines are sent from their first place only; others once per batch.
HOT_CLASSES = 1 << 18
#: The lines of a word in more prefix rows than this meet the earliest ones first, so many at most.
FEW, LEADERS = 1024, 16
#: The rows of a word in more lines than this are dealt to cells, each for two of so many groups of lines.
MANY, GROUPS = 1 << 12, 8
#: Earlier lines that a prefix word proposes to a line at first.
NEAREST = 2
#: Words and prefix rows go in blocks by so many leading bits of a hash.
_BLOCK_BITS = 11
#: Open lines sent to every task as they are (16 MB); more are sent as a bit table, which lets a few others pass.
SETTLED = 1 << 21
#: Pairs of rows that a task looks at together.
_AT_ONCE = 1 << 20
#: Rows of at most five numbers (20 MB) that are broadcast at most; longer tables are joined by shuffle.
MOST_SENT = 1 << 19
_NO_ID = np.iinfo(np.int64).max
_D1, _D2 = 0x1234567, 0x89ABCDEF


def _by_line(line: np.ndarray, key: np.ndarray, n_lines: int) -> np.ndarray:
    """Order by line, then by the leading 48 bits of ``key``; one key sorts several times faster than two."""
    if n_lines > 1 << 16:
        return np.lexsort((key, line))
    return np.argsort((line.astype(np.uint64) << np.uint64(48)) | (key >> np.uint64(16)))


class _Lines:
    """The distinct words of every line of a few texts, sorted by line and hash.

    With ``probed`` (a bit table) only the lines with a word that may be in it.
    """

    def __init__(self, texts: list, least: int, probed: np.ndarray | None = None):
        words = X.Words(texts)
        breaks = np.flatnonzero(words.buf == 10)
        ends = words.text_ends - 1  # the separator behind each text also ends its last line
        bounds = np.sort(np.concatenate([breaks, ends]))
        n_words = np.diff(np.searchsorted(words.starts, bounds), prepend=0)
        line, h = np.repeat(np.arange(len(bounds)), n_words), words.hashes
        if probed is not None:
            held = np.zeros(len(bounds), dtype=bool)
            held[line[present(probed, h)]] = True
            held = np.repeat(held, n_words)
            line, h = line[held], h[held]
        order = _by_line(line, h, len(bounds))
        line, h = line[order], h[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (line[1:] != line[:-1]) | (h[1:] != h[:-1])
        line, h = line[new], h[new]
        sizes = np.bincount(line, minlength=len(bounds))
        long_enough = sizes >= least
        keep = long_enough[line]
        self.line, self.hashes = line[keep], h[keep]
        self.lines = np.flatnonzero(long_enough)  # numbers of the lines that take part
        self.sizes = sizes[self.lines]
        self.starts = np.cumsum(self.sizes) - self.sizes
        last = np.searchsorted(bounds, ends)
        first = np.append(0, last[:-1] + 1)
        self.per_text = last - first + 1
        self.text = np.searchsorted(last, self.lines)
        self.line_no = self.lines - first[self.text]

    def digest(self, salt: int) -> np.ndarray:
        return np.add.reduceat(X.mixed(self.hashes, salt), self.starts) if len(self.lines) else np.zeros(0, np.uint64)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        return self.digest(_D1), self.digest(_D2)

    def parities(self) -> tuple[np.ndarray, np.ndarray]:
        """Per line 128 bits, each telling whether an odd number of its words fall on it.

        Bits in which two lines differ come from words that only one of them has, so there are at least that
        many such words. With 64 bits, unlike lines of more than a hundred words differ in too few.
        """
        bit, upper = np.uint64(1) << (self.hashes & np.uint64(63)), (self.hashes >> np.uint64(6)) & np.uint64(1)
        high = bit * upper
        return tuple(np.bitwise_xor.reduceat(half, self.starts) for half in (bit ^ high, high))


_LISTED = "doc_id long, place long, n_lines long, line_no array<long>, d1 array<long>, d2 array<long>, block int, words binary, counts binary"


def _by_block(block: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """The numbers of the blocks of sorted rows, their rows and, column by column, the bytes of each."""
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    ends = np.append(starts[1:], len(block))
    ranges = list(zip(starts.tolist(), ends.tolist(), strict=True))
    return block[starts].astype(np.int32), (ends - starts).astype(np.int32), [[c[a:b].tobytes() for a, b in ranges] for c in columns]


def _listed(least: int, joined: int):
    """doc_id, place, text -> doc_id, place, n_lines and parallel lists of the lines that take part.

    After the rows of a batch come the batch's distinct words, packed in blocks by their leading bits, and in how many
    of its lines of at least ``joined`` words each occurs; only in these rows ``block`` is not null.
    """

    def run(batches):
        for batch in batches:
            texts = X.raw_texts(batch.column(2))
            null = batch.column(2).is_null().to_numpy(zero_copy_only=False)
            n_lines, nos, d1, d2, hashes = [], [], [], [], []
            for a, b in X.pieces(texts):
                lines = _Lines(texts[a:b], least)
                n_lines.append(lines.per_text)
                hashes.append(lines.hashes[np.repeat(lines.sizes >= joined, lines.sizes)])
                one, two = lines.digests()
                cut = np.searchsorted(lines.text, np.arange(1, b - a))
                for out, values in ((nos, lines.line_no), (d1, X.signed(one)), (d2, X.signed(two))):
                    out.extend(np.split(values, cut))
            if not texts:
                continue
            count = np.where(null, 0, np.concatenate(n_lines))
            none = [pa.nulls(len(texts), kind) for kind in (pa.int32(), pa.binary(), pa.binary())]
            columns = [batch.column(0), batch.column(1), pa.array(count), *map(X.long_lists, (nos, d1, d2)), *none]
            names = [f.split()[0] for f in _LISTED.split(", ")]
            yield pa.record_batch(columns, names)
            words, n = np.unique(np.concatenate(hashes), return_counts=True)
            if not len(words):
                continue
            block, _, blobs = _by_block(words >> np.uint64(64 - _BLOCK_BITS), [words, n.astype(np.uint32)])
            nothing = [pa.nulls(len(block), pa.int64())] * 3 + [pa.nulls(len(block), pa.list_(pa.int64()))] * 3
            yield pa.record_batch([*nothing, pa.array(block), *(pa.array(b, pa.binary()) for b in blobs)], names)

    return run


def _summed(batches):
    """block, words, counts in the order of blocks -> word, n of the words that occur in more than one line."""

    def total(parts):
        words, n = (np.concatenate([np.frombuffer(p[k].as_buffer(), kind) for p in parts]) for k, kind in enumerate((np.uint64, np.uint32)))
        order = np.argsort(words)
        words, n = words[order], n[order].astype(np.int64)
        starts = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        n = np.add.reduceat(n, starts)
        return pa.record_batch([pa.array(X.signed(words[starts][n > 1])), pa.array(n[n > 1])], ["word", "n"])

    block, parts = None, []
    for batch in batches:
        for at, *part in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            if at != block and parts:
                yield total(parts)
                parts = []
            block = at
            parts.append(part)
    if parts:
        yield total(parts)


def least_joined(similarity: Fraction) -> int:
    """The fewest words of a line that a line with another set can be similar to: one word more or less at best."""
    up, down = similarity.numerator, similarity.denominator
    return -(-up // (down - up)) if up < down else np.iinfo(np.int64).max


def prefix_lengths(sizes: np.ndarray, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Words to probe with, and words to index when the partner is not shorter."""
    up, down = similarity.numerator, similarity.denominator
    probe = sizes - -(-sizes * up // down) + 1
    index = sizes - -(-2 * sizes * up // (up + down)) + 1
    return probe, index


def _half(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _prefix_rows(batch, least: int, similarity: Fraction, ranks, shared, hot, probed=None) -> list | None:
    """doc_id, place, text -> the prefix words of every line, as columns: hash, d1, two of parities, size, position,
    document, place, line number.

    A line is sent once per batch, where it stands first; a line of a hot class only where the class stands first.
    With ``probed`` only the lines with a word that may be in it are looked at.
    """
    hot_d1, hot_place, hot_line = hot.value
    docs, places = batch.column(0).fill_null(_NO_ID).to_numpy(), batch.column(1).to_numpy()
    order = np.lexsort((places, docs))
    docs, places = docs[order], places[order]
    texts, parts = X.raw_texts(batch.column(2)), []
    texts = [texts[i] for i in order.tolist()]
    for a, b in X.pieces(texts):
        x = _Lines(texts[a:b], least, None if probed is None else probed.value)
        if not len(x.lines):
            continue
        one = x.digest(_D1)
        sent = np.ones(len(one), dtype=bool)
        if len(hot_d1):
            at = np.minimum(np.searchsorted(hot_d1, one), len(hot_d1) - 1)
            here = (hot_place[at] == places[a:b][x.text]) & (hot_line[at] == x.line_no)
            sent = (hot_d1[at] != one) | here
        # Once per piece, of those that are sent at all: a copy may stand before its class's first place.
        able = np.flatnonzero(sent)
        sent[:] = False
        sent[able[np.unique(one[able], return_index=True)[1]]] = True
        probe, _ = prefix_lengths(x.sizes, similarity)
        of, h = np.repeat(np.arange(len(one)), x.sizes), x.hashes
        if not sent.all():
            here = sent[of]
            of, h = of[here], h[here]
        if not len(h):
            continue
        common = present(shared.value, h)
        # Rarest first, up to a count of a million; then the hash decides. Words of one line only lead.
        rank = np.where(common, ranks[h >> np.uint64(64 - _RANK_BITS)], 0).astype(np.uint64)
        key = (rank << np.uint64(44)) | (h >> np.uint64(20))
        order = _by_line(of, key, len(one))
        sizes = np.where(sent, x.sizes, 0)
        position = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # The rows stay in the order of lines when they are sorted.
        keep = np.flatnonzero(position < probe[of])
        keep = keep[common[order[keep]]]
        line, words = of[keep], h[order[keep]]
        text = x.text[line]
        parts.append([words, *(v[line] for v in (one, *x.parities(), x.sizes)), position[keep], docs[a:b][text], places[a:b][text], x.line_no[line]])
    if not parts:
        return None
    rows = [np.concatenate(v) for v in zip(*parts, strict=True)]
    _, first = np.unique(X.mixed(rows[0]) ^ rows[1], return_index=True)
    return [v[first] for v in rows]


def _rank_table(ranked) -> np.ndarray:
    ranks = np.ones(1 << _RANK_BITS, dtype=np.uint32)
    words, counts = ranked.value
    np.maximum.at(ranks, words >> np.uint64(64 - _RANK_BITS), counts)
    return np.minimum(ranks, (1 << 20) - 1, out=ranks)


def _cell(word: np.ndarray, one: np.ndarray | int, other: np.ndarray | int) -> np.ndarray:
    """The keys of words (halves of hashes) for lines of two groups."""
    cell = np.minimum(one, other) * np.uint64(GROUPS) + np.maximum(one, other) + np.uint64(1)
    return _half(X.mixed(word.astype(np.uint64) * np.uint64(GROUPS * GROUPS + 1) + cell))


def _probing(many, wanted):
    """word -> the words whose prefix rows may have a key in ``wanted``."""

    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            held, copied = present(wanted.value, h), np.flatnonzero(present(many.value, h))
            word, keys = _half(h[copied]), np.zeros(len(copied), dtype=bool)
            for g in range(GROUPS):
                for k in range(g, GROUPS):
                    keys |= present(wanted.value, _cell(word, np.uint64(g), np.uint64(k)).astype(np.uint64) << np.uint64(32))
            held[copied] = keys
            yield pa.record_batch([batch.column(0).filter(pa.array(held))], ["word"])

    return run


def _blocks(least: int, similarity: Fraction, ranked, shared, hot, many, wanted=None, probed=None):
    """doc_id, place, text -> block, rows: all prefix rows of a batch whose keys fall in a block, column by column.

    The key is half of the word's hash. A row of a word in ``many`` gets one key per cell of its line's group. With
    ``wanted`` only the rows of keys that may be in it; ``probed`` holds the words that may have such keys.
    """

    def run(batches):
        ranks = _rank_table(ranked)
        for batch in batches:
            rows = _prefix_rows(batch, least, similarity, ranks, shared, hot, probed)
            if not rows or not len(rows[0]):
                continue
            h, one, low, high, size, position, doc, place, line = rows
            word, key = _half(h), _half(h)
            copied = np.flatnonzero(present(many.value, h))
            group = (one[copied] >> np.uint64(16)) % np.uint64(GROUPS)
            keys, at = [np.delete(key, copied)], [np.delete(np.arange(len(h)), copied)]
            for g in map(np.uint64, range(GROUPS)):
                keys.append(_cell(word[copied], group, g))
                at.append(copied)
            key, at = np.concatenate(keys), np.concatenate(at)
            if wanted is not None:
                keep = present(wanted.value, key.astype(np.uint64) << np.uint64(32))
                key, at = key[keep], at[keep]
                if not len(key):
                    continue
            order = np.argsort((key.astype(np.uint64) << np.uint64(32)) | size[at].astype(np.uint64))
            key, at = key[order], at[order]
            small = max(size.max(), line.max()) <= np.iinfo(np.uint16).max
            near = int(doc.max()) - int(doc.min()) <= np.iinfo(np.uint32).max
            base = int(doc.min()) if near else 0
            doc = (doc - base).astype(np.uint32) if near else doc
            numbers = (v.astype(np.uint16 if small else np.uint32) for v in (line, size, position))
            columns = [key, *(v[at] for v in (one, low, high, doc, place, *numbers))]
            block, counts, blobs = _by_block(key >> np.uint32(32 - _BLOCK_BITS), columns)
            blobs = [b"".join(parts) for parts in zip(*blobs, strict=True)]
            same = lambda v, t: pa.array(np.full(len(block), v), t)
            arrays = [pa.array(block), pa.array(counts), same(base, pa.int64()), same(near, pa.bool_()), same(small, pa.bool_()), pa.array(blobs, pa.binary())]
            yield pa.record_batch(arrays, [f.split()[0] for f in _PACKED.split(", ")])

    return run


_PACKED = "block int, n int, base long, near boolean, small boolean, rows binary"


def _columns(n: int, base: int, near: bool, small: bool, blob: memoryview) -> list:
    """The columns of a block's part: key, d1, two of parities, document, place, line number, size, position."""
    number = np.uint16 if small else np.uint32
    out, at = [], 0
    for kind in (np.uint32, *[np.uint64] * 3, np.uint32 if near else np.int64, np.int64, number, number, number):
        out.append(np.frombuffer(blob, kind, n, at))
        at += out[-1].nbytes
    out[4] = out[4].astype(np.int64) + base
    return out


class _Block:
    """The prefix rows of a block by key, then size."""

    def __init__(self, parts: list, similarity: Fraction):
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        order = np.argsort((columns[0].astype(np.uint64) << np.uint64(32)) | columns[7].astype(np.uint64))
        self.key, self.one, self.low, self.high, self.doc, self.place, self.line, size, position = (v[order] for v in columns)
        self.size = size = size.astype(np.int64)
        self.up, self.down = similarity.numerator, similarity.denominator
        self.indexed, self.rest = position < prefix_lengths(size, similarity)[1], size - position
        number, far = np.cumsum(np.append(0, self.key[1:] != self.key[:-1])), int(size.max()) + 1
        # Partners of a row have its key and are neither too short nor too long.
        at = number * far + size
        self.begin = np.searchsorted(at, number * far - (-size * self.up // self.down))
        self.end = np.searchsorted(at, number * far + np.minimum(size * self.down // self.up, far - 1), side="right")
        self.starts = np.append(np.flatnonzero(np.append(True, number[1:] != number[:-1])), len(number))

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(earlier, later, least number of words that only one has) of the pairs of rows that pass the filters.

        ``i`` stands before ``j`` in the block.
        """
        up, down = self.up, self.down
        size, one, low, high, rest = self.size, self.one, self.low, self.high, self.rest
        for passes in (
            lambda i, j: (self.indexed[i] | (size[i] == size[j]) & self.indexed[j]) & (one[i] != one[j]) & (size[j] * up <= size[i] * down),
            lambda i, j: np.bitwise_count(low[i] ^ low[j]).astype(np.int64) * (up + down) <= (size[i] + size[j]) * (down - up),
            lambda i, j: np.minimum(rest[i], rest[j]) * (up + down) >= (size[i] + size[j]) * up,
        ):
            keep = passes(i, j)
            i, j = i[keep], j[keep]
        apart = np.bitwise_count(low[i] ^ low[j]).astype(np.int64) + np.bitwise_count(high[i] ^ high[j])
        keep = apart * (up + down) <= (size[i] + size[j]) * (down - up)
        i, j, apart = i[keep], j[keep], apart[keep]
        first = self.line[i] < self.line[j]
        for v in (self.place, self.doc):
            first = (v[i] < v[j]) | (v[i] == v[j]) & first
        return np.where(first, i, j), np.where(first, j, i), apart

    def covered(self, a: int, b: int) -> tuple[np.ndarray, list]:
        """Rows a to b, of one key: those that no leader (an early row) is near to, and the leaders' pairs."""
        left = np.lexsort((self.line[a:b], self.place[a:b], self.doc[a:b])) + a
        leaders, found = [], []
        while len(left) > 1 and len(leaders) < LEADERS:
            leader, left = left[0], left[1:]
            leaders.append(leader)
            found.append(self.near(np.minimum(leader, left), np.maximum(leader, left)))
            left = np.setdiff1d(left, found[-1][1], assume_unique=True)
        return np.append(np.array(leaders, dtype=np.int64), left), found

    def nearest(self, found: list, most: int | None, all_seen: np.ndarray) -> np.ndarray:
        """(d1 of the earlier, d1 of the later, key, whether that key may have more for the later line), no repeats."""
        i, j, apart = (np.concatenate(v) for v in zip(*found, strict=True))
        rows = np.stack([self.key[j].astype(np.uint64), self.one[j], apart.astype(np.uint64), self.one[i], (~all_seen[j]).astype(np.uint64)])
        rows = rows[:, np.lexsort(rows[::-1])]
        new = np.ones(rows.shape[1], dtype=bool)
        new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
        key, later, _, earlier, unseen = rows = rows[:, new]
        if not len(key):
            return np.zeros((4, 0), dtype=np.uint64)
        most = len(key) if most is None else most
        head = np.flatnonzero(np.append(True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)))
        n = np.diff(np.append(head, len(key)))
        more = np.repeat((n > most) | (np.maximum.reduceat(unseen, head) > 0), n)
        keep = np.arange(len(key)) - np.repeat(head, n) < most
        return np.stack([earlier, later, key, more.astype(np.uint64)])[:, keep]


def _proposed(parts: list, similarity: Fraction, few: int, most: int, opened) -> np.ndarray:
    """Pairs of lines of a block that share a prefix word and pass the filters: see ``_Block.nearest``.

    Without ``opened`` the ``most`` nearest ones of every line and word, else all of the lines that are in it.
    """
    x, found = _Block(parts, similarity), []
    n, at = len(x.key), np.arange(len(x.key))
    if opened is None:
        # All rows look at those behind them; where leaders were tried, only rows without one look, and both ways.
        target, begin = np.ones(n, dtype=bool), at + 1
        sizes = np.diff(x.starts)
        for k in np.flatnonzero(sizes > few).tolist():
            a, b = x.starts[k], x.starts[k + 1]
            left, pairs = x.covered(a, b)
            found += pairs
            target[a:b] = False
            target[left] = True
            begin[a:b] = x.begin[a:b]
    else:
        target, begin = opened(x.one), x.begin
    count = np.where(target, x.end - begin, 0)
    sums, a = np.cumsum(count), 0
    while a < n:
        done = sums[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(sums, done + _AT_ONCE, side="right")))
        i = np.repeat(np.arange(a, b), count[a:b])
        j = np.arange(len(i)) - (np.repeat(sums[a:b] - count[a:b], count[a:b]) - done) + begin[i]
        i, j = np.minimum(i, j), np.maximum(i, j)
        i, j, apart = x.near(i, j)
        keep = target[j]
        found.append((i[keep], j[keep], apart[keep]))
        a = b
    return x.nearest(found, most if opened is None else None, target)


def _compared(similarity: Fraction, few: int, most: int, opened=None):
    """Blocks in order -> the pairs of lines proposed. ``opened`` holds the d1 of open lines, sorted, or a bit table."""

    def held(one):
        table = opened.value
        if table.dtype == np.uint8:
            return present(table, one)
        return table[np.minimum(np.searchsorted(table, one), len(table) - 1)] == one

    def run(batches):
        block, parts = None, []
        for batch in batches:
            numbers = zip(*(batch.column(k).to_pylist() for k in range(5)), batch.column(5), strict=True)
            for at, n, base, near, small, blob in numbers:
                if at != block and parts:
                    yield _pairs(_proposed(parts, similarity, few, most, opened and held))
                    parts = []
                block = at
                parts.append(_columns(n, base, near, small, memoryview(blob.as_buffer())))
        if parts:
            yield _pairs(_proposed(parts, similarity, few, most, opened and held))

    return run


def _pairs(rows: np.ndarray) -> pa.RecordBatch:
    numbers = [pa.array(X.signed(np.ascontiguousarray(v))) for v in rows[:3]]
    return pa.record_batch([*numbers, pa.array(rows[3] > 0)], ["a1", "b1", "key", "more"])


def _sets(least: int, wanted, homes):
    """place, text -> whole sets of the lines whose d1 is wanted, from the texts whose place is in ``homes``."""

    def run(batches):
        for batch in batches:
            home = present(homes.value, batch.column(0).to_numpy().view(np.uint64))
            texts, seen = [t for t, held in zip(X.raw_texts(batch.column(1)), home.tolist(), strict=True) if held], {}
            for a, b in X.pieces(texts):
                x = _Lines(texts[a:b], least)
                one, two = x.digests()
                for i in np.flatnonzero(present(wanted.value, one)).tolist():
                    seen[one[i], two[i]] = x.hashes[x.starts[i] : x.starts[i] + x.sizes[i]]
            if seen:
                d1, d2 = (np.array([k[i] for k in seen], dtype=np.uint64) for i in (0, 1))
                lists = X.long_lists([X.signed(v) for v in seen.values()])
                yield pa.record_batch([pa.array(X.signed(d1)), pa.array(X.signed(d2)), lists], ["d1", "d2", "words"])

    return run


def _verified(similarity: Fraction):
    """d1, d2, two sets -> d1, d2 of the rows whose sets are similar."""

    def run(batches):
        for batch in batches:
            keep = []
            for s, t in zip(batch.column(2), batch.column(3), strict=True):
                s, t = np.asarray(s.values), np.asarray(t.values)
                union = len(s) + len(t) - len(np.intersect1d(s, t, assume_unique=True))
                keep.append((len(s) + len(t) - union) * similarity.denominator >= similarity.numerator * union)
            yield batch.select(["d1", "d2"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sent(table: DataFrame) -> DataFrame:
    """A stored table with the hint to broadcast it if it is short enough."""
    return F.broadcast(table) if table.count() <= MOST_SENT else table


class LineDedup:
    """Which lines of ``docs`` go because an equal or similar line stands earlier.

    Lines with fewer than ``least_words`` distinct words never match; with 1 all lines that have a word take part,
    headings too. Lines too short to be similar to any other set (``least_joined``) match equal ones without being
    joined. Earlier means by ``doc_id`` (null last), then by text, then by line number; among
    rows that repeat both id and text one is first. Null texts have no lines, empty texts one empty line.
    Other columns are not looked at.
    """

    def __init__(self, docs: DataFrame, similarity: float = 0.8, least_words: int = 5):
        self.docs, self.spark = docs, docs.sparkSession
        self.similarity, self.least = Fraction(str(similarity)), least_words
        self.joined = max(least_words, least_joined(self.similarity))
        text = F.col("text").cast("string")
        self.places = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("place"), text.alias("text"))
        self.scratch = Scratch(self.spark, "line-dedup")

    def _later(self, listed: DataFrame, classes: DataFrame) -> DataFrame:
        """The classes (d1, d2) that are similar to a class that stands earlier."""
        s = self.scratch
        counts = listed.where("block IS NOT NULL").select("block", "words", "counts").repartition("block").sortWithinPartitions("block")
        counts = s.store(counts.mapInArrow(_summed, "word long, n long"), "word-counts")
        shared = bitset(counts, F.col("word"))
        # A fixed number of words with their counts: 4 MB at most.
        top = counts.orderBy(F.desc("n"), "word").limit(RANKED_WORDS).toArrow()
        words = top.column("word").to_numpy().view(np.uint64)
        order = np.argsort(words)
        ranked = self.spark.sparkContext.broadcast((words[order], np.minimum(top.column("n").to_numpy()[order] + 1, 1 << 30).astype(np.uint32)))
        # A fixed number of classes: those with most copies, with the place of their first line.
        most = classes.where("n > 1").orderBy(F.desc("n"), "d1").limit(HOT_CLASSES)
        most = most.select("d1", F.col("first.place").alias("place"), F.col("first.line_no").alias("line_no")).toArrow()
        keys = most.column("d1").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        hot = self.spark.sparkContext.broadcast((keys[order], *(most.column(c).to_numpy()[order] for c in ("place", "line_no"))))
        many = bitset(counts.where(F.col("n") > MANY), F.col("word"))
        packing = (self.joined, self.similarity, ranked, shared, hot, many)
        pairs = s.store(self._candidates(_blocks(*packing), _compared(self.similarity, FEW, NEAREST)), "candidates")
        sets = self._sets(pairs, classes, None)
        settled = s.store(self._late(pairs, sets), "settled")
        unsettled = pairs.join(_sent(settled.select(F.col("d1").alias("b1")).distinct()), "b1", "left_anti")
        opened = s.store(unsettled.where("more").select("b1", "keys"), "open")
        late, sent = settled, [shared, ranked, hot, many]
        if not opened.isEmpty():
            lines = opened.select("b1").distinct()
            if lines.count() <= SETTLED:
                lines = lines.toArrow().column("b1").to_numpy().view(np.uint64)
                lines = self.spark.sparkContext.broadcast(np.sort(lines))
            else:
                lines = bitset(lines, F.col("b1"))
            wanted = bitset(opened.select(F.explode("keys").alias("key")), F.shiftleft("key", 32))
            probed = bitset(counts.select("word").mapInArrow(_probing(many, wanted), "word long"), F.col("word"))
            sent += [lines, wanted, probed]
            rest = self._candidates(_blocks(*packing, wanted, probed), _compared(self.similarity, FEW, NEAREST, lines))
            rest = s.store(rest.join(pairs.select("a1", "b1"), ["a1", "b1"], "left_anti"), "candidates")
            more = self._late(rest, self._sets(rest, classes, sets))
            late = more.unionByName(settled).distinct()
        for x in sent:
            x.destroy()
        return late

    def _candidates(self, pack, compare) -> DataFrame:
        """Pairs (a1 earlier, b1 later) of lines that may be similar, with their keys."""
        blocks = self.places.mapInArrow(pack, _PACKED).repartition("block").sortWithinPartitions("block")
        pairs = blocks.mapInArrow(compare, "a1 long, b1 long, key long, more boolean")
        return pairs.groupBy("a1", "b1").agg(F.collect_set("key").alias("keys"), F.max("more").alias("more"))

    def _sets(self, pairs: DataFrame, classes: DataFrame, known: DataFrame | None) -> DataFrame:
        """d1, d2, words (the whole set) and first place of the lines of ``pairs``, each read where it stands first; those
        known are not read again.
        """
        ends = pairs.select(F.explode(F.array("a1", "b1")).alias("d1")).distinct()
        if known is not None:
            ends = ends.join(known.select("d1").distinct(), "d1", "left_anti")
        ends = self.scratch.store(classes.join(ends, "d1").select("d1", "d2", "first"), "wanted")
        wanted, homes = bitset(ends, F.col("d1")), bitset(ends, F.col("first.place"))
        found = self.places.select("place", "text").mapInArrow(_sets(self.joined, wanted, homes), "d1 long, d2 long, words array<long>")
        found = found.join(ends, ["d1", "d2"]).dropDuplicates(["d1", "d2"])
        found = self.scratch.store(found, "sets")
        for sent in (wanted, homes):
            sent.destroy()
        return found if known is None else known.unionByName(found)

    def _late(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The later class (d1, d2) of every pair that is similar as whole sets."""
        side = lambda c: sets.select(F.col("d1").alias(f"{c}1"), F.col("d2").alias(f"{c}2"), F.col("words").alias(f"{c}w"), F.col("first").alias(f"{c}f"))
        both = pairs.select("a1", "b1").join(side("a"), "a1").join(side("b"), "b1")
        later = [F.when(F.col("af") < F.col("bf"), F.col(f"b{k}")).otherwise(F.col(f"a{k}")).alias(f"d{k}") for k in (1, 2)]
        return both.select(*later, "aw", "bw").mapInArrow(_verified(self.similarity), "d1 long, d2 long").distinct()

    def _rows(self) -> tuple[DataFrame, DataFrame]:
        """The rows of docs, numbered by ``uid``, and (uid, removed line numbers) where there are any."""
        s = self.scratch
        listed = s.store(self.places.mapInArrow(_listed(self.least, self.joined), _LISTED).withColumn("uid", F.monotonically_increasing_id()), "lines")
        rows = listed.where("block IS NULL").drop("block", "words", "counts")
        zipped = F.explode(F.arrays_zip("line_no", "d1", "d2")).alias("l")
        lines = rows.select("doc_id", "place", "uid", zipped)
        at = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "place", "uid", F.col("l.line_no").alias("line_no")).alias("at")
        lines = lines.select(F.col("l.d1").alias("d1"), F.col("l.d2").alias("d2"), at)
        classes = s.store(lines.groupBy("d1", "d2").agg(F.min("at").alias("first"), F.count("*").alias("n")), "classes")
        late = self._later(listed, classes).withColumn("late", F.lit(True))
        rules = classes.join(late, ["d1", "d2"], "left").where("n > 1 OR late")
        rules = s.store(rules.select("d1", "d2", "first", F.coalesce("late", F.lit(False)).alias("late")), "rules")
        gone = lines.join(rules, ["d1", "d2"]).where("late OR at != first")
        gone = gone.groupBy("at.uid").agg(F.sort_array(F.collect_list("at.line_no")).alias("removed"))
        return rows.select("doc_id", "place", "uid", "n_lines"), s.store(gone, "removed")

    def report(self) -> DataFrame:
        """``doc_id, n_lines, n_removed, removed_lines`` (numbers from 0) for every row of documents."""
        rows, gone = self._rows()
        removed = F.coalesce("removed", F.array().cast("array<long>"))
        out = rows.join(gone, "uid", "left")
        return out.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed_lines"))

    def clean(self) -> DataFrame:
        """The documents without those lines, all other columns as they were.

        A document that loses lines and keeps no word goes; one that lost none stays whatever it holds. Rows
        that repeat id and text are later matches of one another: one stays.
        """
        rows, gone = self._rows()
        keyed = rows.join(gone, "uid", "left")
        first = keyed.groupBy("doc_id", "place").agg(F.min(F.struct("uid", "removed")).alias("f"), F.count("*").alias("n"))
        cut = first.where("n > 1 OR f.removed IS NOT NULL")
        cut = cut.select(F.col("doc_id").alias("__line_doc"), F.col("place").alias("__line_place"), F.col("f.removed").alias("__line_gone"), F.col("n").alias("__line_rows"))
        cut = self.scratch.store(cut, "cuts")
        text = F.col("text").cast("string")
        here = F.col("doc_id").cast("long").eqNullSafe(F.col("__line_doc")) & (F.xxhash64(text) == F.col("__line_place"))
        docs = self.docs.join(cut, here, "left")
        once = docs.where("__line_rows > 1").dropDuplicates(["__line_doc", "__line_place"])
        docs = docs.where("__line_rows IS NULL OR __line_rows = 1").unionByName(once)
        kept = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains("__line_gone", i.cast("long")))
        left = F.array_join(F.when(F.col("__line_gone").isNull(), F.array(text)).otherwise(kept), "\n")
        out = docs.withColumn("text", F.when(text.isNotNull(), left))
        return out.where(F.col("__line_gone").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(self.docs.columns)


def report(docs: DataFrame, similarity: float = 0.8, least_words: int = 5) -> DataFrame:
    """See :meth:`LineDedup.report`."""
    return LineDedup(docs, similarity, least_words).report()


def clean(docs: DataFrame, similarity: float = 0.8, least_words: int = 5) -> DataFrame:
    """See :meth:`LineDedup.clean`."""
    return LineDedup(docs, similarity, least_words).clean()
