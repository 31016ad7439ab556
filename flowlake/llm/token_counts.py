"""Token counts of whole texts without making their tokens.

Texts are cut where no vocabulary piece can reach across: at line feeds, and before a run of spaces. Pieces are
counted once per distinct part of the corpus, and every text adds up its parts (:mod:`bags`).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm import bags
from flowlake.llm import textops as X
from flowlake.llm.scratch import Scratch

#: Fixed value: the mark that the vocabulary uses for a space, U+2581.
_MARK = "▁".encode()


class PreTokens:
    """Parts of a few texts: a line feed, or spaces and the other characters behind them.

    Every non-empty text starts with the space that the tokenizer puts before it. The vocabulary's own mark
    for a space is read as a space, as the tokenizer does.
    """

    def __init__(self, texts: list):
        parts = [b" " + bytes(t).replace(_MARK, b" ") if len(t) else b"" for t in texts]
        self.buf = np.frombuffer(b"".join(parts), dtype=np.uint8)
        ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
        feed, space = self.buf == 10, self.buf == 32
        start = feed | space
        start[1:] = feed[1:] | feed[:-1] | (space[1:] & ~space[:-1])
        first = np.append(0, ends[:-1])
        start[first[first < ends]] = True
        self.starts = np.flatnonzero(start)
        self.ends = np.append(self.starts[1:], len(self.buf)) if len(self.starts) else self.starts
        self.hashes = X.span_hashes(self.buf, self.starts, self.ends, X.BYTE_CODES)
        self.counts = np.diff(np.searchsorted(self.starts, ends), prepend=0)

    def text_of(self, start: int, end: int) -> bytes:
        return self.buf[start:end].tobytes()


@lru_cache(maxsize=2)
def _processor(model: bytes):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("a piece of this vocabulary reaches across spaces or line feeds")
    return processor


def piece_counts(tokens: list[bytes], model: bytes) -> np.ndarray:
    """Pieces of each part as it stands inside a text. The line feed put before it takes two pieces."""
    found = _processor(model).encode(["\n" + t.decode() for t in tokens], num_threads=1)
    return np.fromiter((len(p) - 2 for p in found), np.int64, len(tokens))


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """The columns of ``docs`` without ``text``, with ``n_bytes`` and ``n_tokens``: one row per row.

    The counts are those of the sentencepiece model at ``model_path`` (a file the driver can read; it is sent
    to the tasks) on the whole text, without begin and end tokens. A null or empty text has none.
    Columns of ``docs`` with the names of the results are replaced.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "token-counts")
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    docs = docs.drop("n_tokens", "n_bytes", "uid", "rest_h", "rest_n", "s0").withColumn("text", F.col("text").cast("string"))
    vocab = bags.vocabulary(docs.select("text", F.lit(True).alias("chosen")), PreTokens).drop("n_in")
    table = bags.valued(vocab, lambda tokens, _: [piece_counts(tokens, model.value)], 1)
    table = scratch.store(table, "counts")
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    out = bags.sums(sized, table, PreTokens, 1, scratch)
    return out.drop("n_tokens").withColumn("n_tokens", F.col("s0").cast("long")).drop("s0")
