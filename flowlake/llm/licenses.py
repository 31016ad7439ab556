"""License scans: an exact set-similarity join of text blocks with license templates.

A text's blocks, for templates of up to ``s`` words (a power of two), are the runs of 2s words that start at every
s-th word, so any run of s words stands inside a block. A template is found in a block that holds at least its
share of the template's distinct words (containment). All blocks that reach it are found:

* tokens are ordered by how often they occur in all documents, rarest first;
* prefix filter: a template with d words that needs c of them shares one of its d-c+1 rarest with the block, so
  only blocks around such a word are looked at;
* length filter: the block has c words of any template at least;
* positional filter: behind the rarest shared word enough words must be left in the order, of the template and
  of the block;
* what is left is verified on the whole sets.

Templates are a parameter that the driver holds. They are dealt in groups of at most ``GROUP_WORDS`` words, each
sent to the tasks for a pass of its own, so what is broadcast is bounded. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm import bags
from flowlake.llm import textops as X

#: Words of the templates that one pass looks for.
GROUP_WORDS = 1 << 18
_TOGETHER = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Template(NamedTuple):
    """A license text; ``containment`` is the share of its distinct words that a block must hold."""

    label: str
    text: str
    containment: str = "1"


class _Terms:
    """The words of a few texts: hash, number of the text, and place in it."""

    def __init__(self, texts: list):
        buf = _LOWER[np.frombuffer(b"\0".join([*texts, b""]), dtype=np.uint8)]
        edge = np.diff(_IN_WORD[buf].view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.hashes = X.span_hashes(buf, starts, ends, X.BYTE_CODES)
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        cut = np.searchsorted(starts, np.cumsum(size))
        self.counts = np.diff(cut, prepend=0)
        self.text = np.repeat(np.arange(len(texts)), self.counts)
        self.place = np.arange(len(starts)) - np.repeat(cut - self.counts, self.counts)


def words(text: str) -> list[str]:
    """The words of one text in order."""
    out, current = [], bytearray()
    for b in text.encode() + b"\0":
        low = int(_LOWER[b])
        if _IN_WORD[low]:
            current.append(low)
        elif current:
            out.append(current.decode())
            current = bytearray()
    return out


class Entry(NamedTuple):
    """A template as it is searched: distinct words, how many are needed, and the reach of its blocks."""

    label: str
    words: list[str]
    needed: int
    reach: int


def entries(templates: list[Template]) -> list[Entry]:
    """Templates without words are refused; so are shares outside 0 to 1."""
    out = []
    for t in templates:
        w, share = words(t.text), Fraction(t.containment)
        if not w or not 0 < share <= 1:
            raise ValueError(f"template {t.label!r} has no words or no share above 0 and up to 1")
        distinct = sorted(set(w))
        out.append(Entry(t.label, distinct, -(-len(distinct) * share.numerator // share.denominator), 1 << (len(w) - 1).bit_length()))
    return out


def _groups(made: list[Entry]) -> Iterator[list[int]]:
    """Numbers of the templates of each pass."""
    group, size = [], 0
    for i, e in enumerate(made):
        if group and size + len(e.words) > GROUP_WORDS:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(e.words)
    yield group


def _known(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """The place of each hash in the sorted vocabulary, -1 if it is not there."""
    if not len(vocabulary):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def _frequencies(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each word of the sorted vocabulary occurs in all texts: one long per word of the templates."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        total = np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            texts = X.raw_texts(batch.column(0))
            for a, b in X.pieces(texts, _TOGETHER):
                at = _known(_Terms(texts[a:b]).hashes, shared.value)
                total += np.bincount(at[at >= 0], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], ["word", "n"])

    out = np.zeros(len(vocabulary), dtype=np.int64)
    for row in docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        out[row.word] = row.n
    return out


class _Index:
    """Templates over ranked words: word 0 is the rarest of all."""

    def __init__(self, made: list[Entry], numbers: list[int], vocabulary: np.ndarray, frequency: np.ndarray):
        self.vocabulary = vocabulary
        order = np.lexsort((vocabulary, frequency))
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        self.templates, self.by_word = [], [[] for _ in order]
        for number in numbers:
            e = made[number]
            ranked = np.sort(self.rank[_known(bags.token_hash([w.encode() for w in e.words]), vocabulary)])
            for r in ranked[: len(ranked) - e.needed + 1].tolist():
                self.by_word[r].append(len(self.templates))
            self.templates.append((number, ranked, e.needed, e.reach))

    def found(self, terms: _Terms) -> list[np.ndarray]:
        """text, template, block number and shared words of all blocks that hold a template."""
        at = _known(terms.hashes, self.vocabulary)
        here = np.flatnonzero(at >= 0)
        rank, text, place = self.rank[at[here]], terms.text[here], terms.place[here]
        wide = int(terms.counts.max(initial=0)) + 2
        out = [[np.zeros(0, np.int64)] * 4]
        listed = {t for r in np.unique(rank).tolist() for t in self.by_word[r]}
        for t in sorted(listed):
            number, ranked, needed, reach = self.templates[t]
            position = np.minimum(np.searchsorted(ranked, rank), len(ranked) - 1)
            of = ranked[position] == rank
            lead = of & (position < len(ranked) - needed + 1)
            block = text * wide + place // reach + 1  # and the block before, which overlaps by half
            open_blocks = np.unique(np.concatenate([block[lead], block[lead] - 1]))
            open_blocks = open_blocks[open_blocks % wide > 0]  # the block before a text's first
            key = np.concatenate([block, block - 1])
            where = _known(key, open_blocks)
            inside = np.flatnonzero(where >= 0)
            where, r, i, shared = (v[inside] for v in (where, np.tile(rank, 2), np.tile(position, 2), np.tile(of, 2)))
            pairs, first = np.unique(where * len(self.rank) + r, return_index=True)
            where, r, i, shared = pairs // len(self.rank), r[first], i[first], shared[first]
            size = np.bincount(where, minlength=len(open_blocks))
            begin = np.cumsum(size) - size
            # The rarest shared word of each block: what stands behind it, in the block and in the template.
            order = np.flatnonzero(shared)
            head, h = np.unique(where[order], return_index=True)
            h = order[h]
            left = np.minimum(begin[head] + size[head] - h, len(ranked) - i[h])
            passed = np.zeros(len(open_blocks), dtype=bool)
            passed[head] = (left >= needed) & (size[head] >= needed)
            count = np.bincount(where[shared & passed[where]], minlength=len(open_blocks))
            good = np.flatnonzero(count >= needed)
            b = open_blocks[good]
            out.append([b // wide, np.full(len(b), number), b % wide - 1, count[good]])
        return [np.concatenate(c) for c in zip(*out, strict=True)]


_FOUND = "template array<long>, block array<long>, shared array<long>"


def _scanned(kept: list[str], names: list[str], index, phrases, count: bool) -> Callable:
    def run(batches):
        for batch in batches:
            texts = X.raw_texts(batch.column(batch.schema.get_field_index("text")))
            numbers, lists = [], [[] for _ in range(4)]
            for a, b in X.pieces(texts, _TOGETHER):
                terms = _Terms(texts[a:b])
                n = b - a
                if count:
                    starts, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                    for p, phrase in enumerate(phrases.value):
                        at = np.flatnonzero(terms.hashes[: max(len(terms.hashes) - len(phrase) + 1, 0)] == phrase[0])
                        for k in range(1, len(phrase)):
                            at = at[(terms.hashes[at + k] == phrase[k]) & (terms.text[at + k] == terms.text[at])]
                        starts.append(at)
                        which.append(np.full(len(at), p))
                    at, which = np.concatenate(starts), np.concatenate(which)
                    text, place = terms.text[at], terms.place[at]
                    first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                    np.minimum.at(first, text, place)
                    np.maximum.at(last, text, place)
                    numbers.append(np.stack([terms.counts, np.bincount(text, minlength=n), first, last]))
                    held = np.unique(text * len(phrases.value) + which)
                    cut = np.searchsorted(held // len(phrases.value), np.arange(1, n))
                    lists[3].extend(np.split(held % len(phrases.value), cut))
                text, *columns = index.value.found(terms)
                order = np.lexsort((columns[1], columns[0], text))
                cut = np.searchsorted(text[order], np.arange(1, n))
                for held, c in zip(lists[:3], columns, strict=True):
                    held.extend(np.split(c[order], cut))
            if texts:
                out = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                if count:
                    n_words, n_base, first, last = np.concatenate(numbers, axis=1)
                    out += [pa.array(n_words), pa.array(n_base), *(pa.array(c, mask=n_base == 0) for c in (first, last)), X.long_lists(lists[3])]
                yield pa.record_batch([*out, *map(X.long_lists, lists[:3])], names)

    return run


class LicenseScan:
    """Places of fixed phrases and blocks that hold license templates, for every text of ``docs``.

    ``phrases`` maps phrases to labels, ``templates`` lists :class:`Template`. Words are runs of ASCII letters,
    digits and other characters beyond ASCII; only A-Z are lower-cased. A null or empty text has no words. Texts
    are read whole, whatever their length; repeated rows and rows without id are rows like others. Columns of
    ``docs`` with the names of the results are replaced.
    """

    #: Columns of :meth:`documents` beside those of ``docs``.
    MADE = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def __init__(self, docs: DataFrame, phrases: dict[str, str], templates: list[Template]):
        self.spark = docs.sparkSession
        self.docs = docs.drop(*self.MADE, "base", "template", "block", "shared").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
        self.phrases = [words(p) for p in phrases]
        if not self.phrases or not all(self.phrases):
            raise ValueError("every phrase needs a word")
        self.base_labels, self.entries = list(phrases.values()), entries(templates)

    def _found(self) -> DataFrame:
        kept, table = [c for c in self.docs.columns if c != "text"], self.docs
        hashed = [bags.token_hash([w.encode() for w in p]) for p in self.phrases]
        shared = self.spark.sparkContext.broadcast(hashed)
        groups = list(_groups(self.entries))
        for i, numbers in enumerate(groups):
            distinct = sorted({w for n in numbers for w in self.entries[n].words})
            vocabulary = np.unique(bags.token_hash([w.encode() for w in distinct]))
            index = _Index(self.entries, numbers, vocabulary, _frequencies(self.docs, vocabulary))
            sent = self.spark.sparkContext.broadcast(index)
            keep = [c for c in table.columns if c != "text" or i < len(groups) - 1]
            lists = [f"{c}{i}" for c in ("template", "block", "shared")]
            counts = ["n_words", "n_base", "first_word", "last_word", "base"] if i == 0 else []
            types = dict(table.dtypes)
            schema = [*[f"`{c}` {types[c]}" for c in keep], *[f"{c} long" for c in counts[:4]], *[f"{c} array<long>" for c in [*counts[4:], *lists]]]
            table = table.mapInArrow(_scanned(keep, [*keep, *counts, *lists], sent, shared, i == 0), ", ".join(schema))
        joined = {c: F.concat(*[F.col(f"{c}{i}") for i in range(len(groups))]) for c in ("template", "block", "shared")}
        made = ["n_words", "n_base", "first_word", "last_word", "base"]
        return table.select(*kept, *made, *[c.alias(name) for name, c in joined.items()])

    def _labels(self, column: str, names: list[str]) -> Column:
        listed = F.array(*[F.lit(x) for x in names])
        return F.transform(column, lambda i: F.element_at(listed, (i + 1).cast("int")))

    def _share(self) -> Column:
        sizes = F.array(*[F.lit(len(e.words)) for e in self.entries])
        return F.transform(F.arrays_zip("template", "shared"), lambda m: m["shared"] / F.element_at(sizes, (m["template"] + 1).cast("int")))

    def documents(self) -> DataFrame:
        """The columns of ``docs`` without ``text``, and per text the columns ``MADE``.

        ``n_base`` places of phrases, the smallest and the largest word they start at (words from 0, else null),
        their labels, all labels (sorted by code point, comma-joined), and ``score``: 1 with a phrase, else the
        highest share of a template's words in a block that holds it, 0 without one.
        """
        rows = self._found()
        base, more = self._labels("base", self.base_labels), self._labels("template", [e.label for e in self.entries])
        score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(self._share()), F.lit(0.0)))
        kept = [c for c in self.docs.columns if c != "text"]
        joined = [F.array_join(F.array_sort(F.array_distinct(c)), ",") for c in (base, F.concat(base, more))]
        return rows.select(*kept, *self.MADE[:4], joined[0].alias("base_labels"), joined[1].alias("labels"), score.alias("score"))

    def blocks(self) -> DataFrame:
        """One row per text, template and block that holds it: ``label, first_word, last_word, share``.

        The words are those of the block, from 0, the last one included.
        """
        rows = self._found()
        kept = [c for c in self.docs.columns if c != "text"]
        each = rows.select(*kept, "n_words", F.explode(F.arrays_zip("template", "block", "shared")).alias("m"))
        reach = F.element_at(F.array(*[F.lit(e.reach) for e in self.entries]), (F.col("m.template") + 1).cast("int"))
        size = F.element_at(F.array(*[F.lit(len(e.words)) for e in self.entries]), (F.col("m.template") + 1).cast("int"))
        label = F.element_at(F.array(*[F.lit(e.label) for e in self.entries]), (F.col("m.template") + 1).cast("int"))
        first = F.col("m.block") * reach
        return each.select(
            *kept, label.alias("label"), first.alias("first_word"),
            F.least(first + 2 * reach, F.col("n_words")).alias("end"), (F.col("m.shared") / size).alias("share"),
        ).withColumn("last_word", F.col("end") - 1).drop("end")
