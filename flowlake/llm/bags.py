"""Sums over the tokens of every text of values that belong to distinct tokens.

The values are worked out once per distinct token of the corpus. Those of the most frequent tokens, a fixed
number, are sent to the tasks, which add them up at once; that takes the hot tokens and nearly all of the
text out of the shuffle. The other tokens of each text are joined to their values and added up by row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm import textops as X
from flowlake.llm.scratch import Scratch

#: Tokens whose values are sent to every task: 24 MB at most with two values.
FREQUENT = 1 << 20


def _distinct(texts: list, groups: np.ndarray, tokens: Callable) -> pa.RecordBatch:
    """Distinct tokens of a batch as text, with how often they occur, in all and where ``groups`` is true."""
    hashes, counts, inside, place, chunks = [], [], [], [], []
    for a, b in X.pieces(texts):
        t = tokens(texts[a:b])
        h, first, back = np.unique(t.hashes, return_index=True, return_inverse=True)
        hashes.append(h)
        counts.append(np.bincount(back, minlength=len(h)))
        inside.append(np.bincount(back, np.repeat(groups[a:b], t.counts), len(h)).astype(np.int64))
        place.append(np.stack([np.full(len(h), len(chunks)), t.starts[first], t.ends[first]]))
        chunks.append(t)
    if not chunks:
        return pa.record_batch([pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.int64())], ["token", "n", "n_in"])
    h, first, back = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    n, n_in = (np.bincount(back, np.concatenate(x), len(h)).astype(np.int64) for x in (counts, inside))
    words = [chunks[c].text_of(s, e) for c, s, e in np.concatenate(place, axis=1)[:, first].T.tolist()]
    return pa.record_batch([pa.array(words, pa.binary()).cast(pa.string()), pa.array(n), pa.array(n_in)], ["token", "n", "n_in"])


def vocabulary(texts: DataFrame, tokens: Callable) -> DataFrame:
    """``token, n, n_in`` over ``texts(text, chosen)``: occurrences in all texts and in the chosen ones."""

    def run(batches):
        for batch in batches:
            chosen = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            yield _distinct(X.raw_texts(batch.column(0)), chosen, tokens)

    found = texts.select("text", "chosen").mapInArrow(run, "token string, n long, n_in long")
    return found.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_in").alias("n_in"))


def token_hash(tokens: list[bytes]) -> np.ndarray:
    """The hash that the tokenising classes give to a token with these bytes."""
    buf = np.frombuffer(b"".join(tokens), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
    starts = np.append(0, ends[:-1]) if len(tokens) else ends
    return X.span_hashes(buf, starts, ends, X.BYTE_CODES)


def valued(vocab: DataFrame, values: Callable, n_values: int) -> DataFrame:
    """``token, n`` and more to ``h, n, v0 ..``: ``values(token bytes, batch)`` gives one array per value."""
    names = [f"v{i}" for i in range(n_values)]

    def run(batches):
        for batch in batches:
            if len(batch):
                tokens = [t.as_py().encode() for t in batch.column(0)]
                columns = [pa.array(v, pa.float64()) for v in values(tokens, batch)]
                yield pa.record_batch([pa.array(X.signed(token_hash(tokens))), batch.column(1), *columns], ["h", "n", *names])

    return vocab.mapInArrow(run, "h long, n long, " + ", ".join(f"{v} double" for v in names))


def sums(docs: DataFrame, table: DataFrame, tokens: Callable, n_values: int, scratch: Scratch) -> DataFrame:
    """``docs(text, ...)`` without ``text`` and with ``n_tokens, s0 ..``: per row the sums of each value.

    ``table`` has the values of every token of ``docs`` (``h, n, v0 ..``). A null text is empty.
    """
    spark = docs.sparkSession
    names = [f"v{i}" for i in range(n_values)]
    top = table.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    known = top.column("h").to_numpy().view(np.uint64)
    order = np.argsort(known)
    columns = np.stack([top.column(v).to_numpy()[order] for v in names])
    shared = spark.sparkContext.broadcast((known[order], columns))
    kept = [c for c in docs.columns if c != "text"]

    def run(batches):
        known, columns = shared.value
        for batch in batches:
            texts = X.raw_texts(batch.column(batch.schema.get_field_index("text")))
            totals, n_tokens, rest_h, rest_n = [], [], [], []
            for a, b in X.pieces(texts):
                t = tokens(texts[a:b])
                text = np.repeat(np.arange(b - a), t.counts)
                at = np.minimum(np.searchsorted(known, t.hashes), max(len(known) - 1, 0))
                hit = known[at] == t.hashes if len(known) else np.zeros(len(t.hashes), bool)
                totals.append(np.stack([np.bincount(text[hit], v[at[hit]], b - a) for v in columns]))
                n_tokens.append(t.counts)
                h, owner = t.hashes[~hit], text[~hit]
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(h)))
                cut = np.searchsorted(owner[first], np.arange(1, b - a))
                rest_h.extend(np.split(X.signed(h[first]), cut))
                rest_n.extend(np.split(n, cut))
            if texts:
                out = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                out += [pa.array(np.concatenate(n_tokens))]
                out += [pa.array(s) for s in np.concatenate(totals, axis=1)]
                yield pa.record_batch([*out, X.long_lists(rest_h), X.long_lists(rest_n)], [*kept, "n_tokens", *[f"s{i}" for i in range(n_values)], "rest_h", "rest_n"])

    types = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in kept], "n_tokens long", *[f"s{i} double" for i in range(n_values)], "rest_h array<long>, rest_n array<long>"])
    rows = docs.mapInArrow(run, schema).withColumn("uid", F.monotonically_increasing_id())
    rows = scratch.store(rows, "rows")
    rest = rows.where(F.size("rest_h") > 0).select("uid", F.explode(F.arrays_zip("rest_h", "rest_n")).alias("r"))
    rest = rest.select("uid", F.col("r.rest_h").alias("h"), F.col("r.rest_n").alias("k")).join(table, "h")
    rest = rest.groupBy("uid").agg(*[F.sum(F.col(v) * F.col("k")).alias(v) for v in names])
    out = rows.drop("rest_h", "rest_n").join(rest, "uid", "left")
    return out.select(*kept, "n_tokens", *[(F.col(f"s{i}") + F.coalesce(f"v{i}", F.lit(0.0))).alias(f"s{i}") for i in range(n_values)])
