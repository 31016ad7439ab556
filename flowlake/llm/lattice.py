"""Document probabilities from a subword lattice: every way to cut a text into vocabulary pieces counts.

The vocabulary is that of an existing tokenizer file. Its scores order the pieces by merge rank; turned into
Zipf weights they start the model, and expectation-maximisation steps over all distinct training words,
weighted by their counts, turn them into probabilities. No piece reaches across words, so the marginal
probability of a text is the product of its words' marginals and that of the end. A word's marginal is worked
out once, by a forward recursion in log space over all words of one length at a time.
"""

from __future__ import annotations

import math
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm import bags
from flowlake.llm import textops as X
from flowlake.llm.scratch import Scratch

#: Expectation-maximisation steps.
STEPS = 2
#: Longer words are worked out one by one.
_LONG = 128
#: Bytes of a long word whose pieces are looked up at once.
_WINDOW = 1 << 16
#: Base counts' smoothing.
SMOOTHING = 0.1
_LN10 = math.log(10)


class Vocabulary:
    """Byte strings with natural log probabilities. Every single byte is a piece, so all words have a path."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        hashes = bags.token_hash(pieces)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        self.log_p = np.append(log_p, -np.inf)  # the last entry stands for no piece
        sizes = np.array([len(p) for p in pieces])
        self.longest = int(sizes.max())
        self.lengths = np.unique(sizes).tolist()

    def find(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.ids[at], len(self.log_p) - 1)


def read_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece file as bytes (its space mark as a space) and Zipf weights from their scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {bytes([b]): 0.0 for b in range(256)}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        text = sp.id_to_piece(i)
        piece = bytes([int(text[3:5], 16)]) if sp.is_byte(i) else text.replace("▁", " ").encode()
        # Scores fall by one with every merge; byte pieces and unmerged characters come last.
        rank = -sp.get_score(i) if -sp.get_score(i) < sp.get_piece_size() else sp.get_piece_size()
        weight[piece] = weight.get(piece, 0.0) + 1 / (rank + 2.7)
    for b in range(256):
        weight[bytes([b])] = max(weight[bytes([b])], 1 / (2 * sp.get_piece_size()))
    pieces = list(weight)
    w = np.array([weight[p] for p in pieces])
    return pieces, w / w.sum()


def _by_length(words: list[bytes]):
    sizes = np.array([len(w) for w in words])
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        yield n, rows, np.frombuffer(b"".join(words[i] for i in rows.tolist()), np.uint8).reshape(len(rows), n)


def _found(vocab: Vocabulary, chars: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """Piece numbers of all spans (from, to) of equally long words."""
    rows, n = chars.shape
    flat = np.ascontiguousarray(chars).ravel()
    base = np.arange(rows) * n
    out = {}
    for size in vocab.lengths:
        if size > n:
            break
        starts = (base[:, None] + np.arange(n - size + 1)).ravel()
        ids = vocab.find(X.span_hashes(flat, starts, starts + size, X.BYTE_CODES)).reshape(rows, -1)
        for i in range(n - size + 1):
            out[i, i + size] = ids[:, i]
    return out


def _forward(vocab: Vocabulary, spans: dict, rows: int, n: int) -> np.ndarray:
    alpha = np.full((n + 1, rows), -np.inf)
    alpha[0] = 0.0
    for j in range(1, n + 1):
        for size in vocab.lengths:
            if size > j:
                break
            np.logaddexp(alpha[j], alpha[j - size] + vocab.log_p[spans[j - size, j]], out=alpha[j])
    return alpha


def _pieces_from(vocab: Vocabulary, flat: np.ndarray, a: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From, to and number of the pieces that start in the window at ``a`` of one word, ordered by their start."""
    b, starts, ids, sizes = min(a + _WINDOW, len(flat)), [], [], []
    for size in vocab.lengths:
        at = np.arange(a, min(b, len(flat) - size + 1))
        if len(at):
            found = vocab.find(X.span_hashes(flat[a : b + size], at - a, at - a + size, X.BYTE_CODES))
            hit = found < len(vocab.log_p) - 1
            starts.append(at[hit])
            ids.append(found[hit])
            sizes.append(np.full(len(ids[-1]), size))
    starts, ids, sizes = (np.concatenate(v) for v in (starts, ids, sizes))
    order = np.argsort(starts, kind="stable")
    return starts[order], (starts + sizes)[order], ids[order]


def _log_add(sums: array, at: int, value: float) -> None:
    high, low = (sums[at], value) if sums[at] > value else (value, sums[at])
    sums[at] = high + math.log1p(math.exp(low - high))


def _long_alpha(vocab: Vocabulary, flat: np.ndarray) -> array:
    alpha = array("d", [0.0]) + array("d", [-math.inf]) * len(flat)
    for a in range(0, len(flat), _WINDOW):
        starts, ends, ids = _pieces_from(vocab, flat, a)
        for i, j, s in zip(starts.tolist(), ends.tolist(), vocab.log_p[ids].tolist(), strict=True):
            _log_add(alpha, j, alpha[i] + s)
    return alpha


def _long_forward(vocab: Vocabulary, word: bytes) -> float:
    return _long_alpha(vocab, np.frombuffer(word, np.uint8))[-1]


def _add_long(vocab: Vocabulary, word: bytes, count: float, total: np.ndarray) -> None:
    """``_add_expected`` for one long word: its pieces are looked up by windows, from the last one back."""
    flat = np.frombuffer(word, np.uint8)
    alpha = _long_alpha(vocab, flat)
    beta = array("d", [-math.inf]) * len(flat) + array("d", [0.0])
    for a in reversed(range(0, len(flat), _WINDOW)):
        starts, ends, ids = _pieces_from(vocab, flat, a)
        log_p = vocab.log_p[ids]
        for i, j, s in zip(starts[::-1].tolist(), ends[::-1].tolist(), log_p[::-1].tolist(), strict=True):
            _log_add(beta, i, beta[j] + s)
        share = np.exp(np.frombuffer(alpha)[starts] + log_p + np.frombuffer(beta)[ends] - alpha[-1])
        total += np.bincount(ids, share * count, len(total))


def log10_marginals(vocab: Vocabulary, words: list[bytes]) -> np.ndarray:
    """log10 of each word's probability, summed over all its segmentations. Words carry their leading space."""
    out = np.empty(len(words))
    for n, rows, chars in _by_length(words):
        if n > _LONG:
            out[rows] = [_long_forward(vocab, words[i]) for i in rows.tolist()]
            continue
        spans = _found(vocab, chars)
        out[rows] = _forward(vocab, spans, len(rows), n)[n]
    return out / _LN10


def expected_counts(vocab: Vocabulary, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """How often each piece is used, over all segmentations by their probability."""
    total = np.zeros(len(vocab.log_p))
    for n, rows, chars in _by_length(words):
        if n > _LONG:
            for i in rows.tolist():
                _add_long(vocab, words[i], counts[i], total)
            continue
        for part in np.array_split(np.arange(len(rows)), -(-len(rows) * n // 200_000)):
            _add_expected(vocab, chars[part], counts[rows[part]], total)
    return total[:-1]


def _add_expected(vocab: Vocabulary, chars: np.ndarray, counts: np.ndarray, total: np.ndarray) -> None:
    rows, n = chars.shape
    spans = _found(vocab, chars)
    alpha = _forward(vocab, spans, rows, n)
    beta = np.full((n + 1, rows), -np.inf)
    beta[n] = 0.0
    for i in range(n - 1, -1, -1):
        for size in vocab.lengths:
            if i + size > n:
                break
            np.logaddexp(beta[i], beta[i + size] + vocab.log_p[spans[i, i + size]], out=beta[i])
    for (i, j), ids in spans.items():
        share = np.exp(alpha[i] + vocab.log_p[ids] + beta[j] - alpha[n])
        np.add.at(total, ids, share * counts) if rows < 64 else total.__iadd__(np.bincount(ids, share * counts, len(total)))


class _Trained:
    """Counts and piece probabilities of the training texts."""

    def __init__(self, docs: DataFrame, model_path: str, scratch: Scratch):
        spark = docs.sparkSession
        vocab = bags.vocabulary(docs, X.Words)
        self.words = scratch.store(vocab, "words")
        n_docs = docs.where("chosen").count()
        row = self.words.where("n_in > 0").agg(F.coalesce(F.sum("n_in"), F.lit(0)), F.count("*")).first()
        #: Training tokens and distinct ones; the end of a text is a token.
        self.n, self.v, self.ends = row[0] + n_docs, row[1] + (n_docs > 0), n_docs
        self.pieces, weights = read_pieces(model_path)
        self.log_p, self.log_end = np.log(weights), 0.0
        for _ in range(STEPS if row[0] else 0):
            self._step(spark)

    def shared(self, spark):
        return spark.sparkContext.broadcast((self.pieces, self.log_p))

    def _step(self, spark) -> None:
        shared = self.shared(spark)

        def run(batches):
            pieces, log_p = shared.value
            vocab, total = Vocabulary(pieces, log_p), np.zeros(len(pieces))
            for batch in batches:
                words = [b" " + t.as_py().encode() for t in batch.column(0)]
                counts = batch.column(1).to_numpy().astype(np.float64)
                if words:
                    total += expected_counts(vocab, words, counts)
            used = np.flatnonzero(total)
            yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(total[used])], ["piece", "n"])

        trained = self.words.where("n_in > 0").select("token", "n_in").mapInArrow(run, "piece int, n double")
        # One row per piece of the vocabulary at most.
        got = trained.groupBy("piece").agg(F.sum("n").alias("n")).toPandas().sort_values("piece")
        counts = np.full(len(self.pieces), SMOOTHING)
        counts[got["piece"].to_numpy()] += got["n"].to_numpy()
        total = counts.sum() + self.ends + SMOOTHING
        self.log_p = np.log(counts / total)
        self.log_end = math.log((self.ends + SMOOTHING) / total)


def lattice_scores(docs: DataFrame, train: Column, model_path: str) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens, n_known, train_tokens, base_score, score``: a row per row.

    The model learns from the texts for which ``train`` is true. Tokens are the lower-cased words and one end.
    ``base_score`` sums the smoothed log10 shares of the tokens among the training tokens, ``n_known`` counts
    those that occur there; ``score`` is the lattice's log10 probability of the text. A null text is empty:
    its only token is the end. Without training texts the pieces keep the weights of their file.
    Columns of ``docs`` with the names of the results are replaced.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lattice")
    text = F.col("text").cast("string")
    source = docs.select(text.alias("text"), F.coalesce(train, F.lit(False)).alias("chosen"))
    model = _Trained(source, model_path, scratch)
    shared, n, v = model.shared(spark), model.n, model.v
    missing = SMOOTHING / (n + SMOOTHING * (v + 1))

    def values(tokens, batch):
        vocab = Vocabulary(*shared.value)
        c = batch.column(2).to_numpy().astype(np.float64)
        scores = log10_marginals(vocab, [b" " + t for t in tokens])
        return [np.log10((c + SMOOTHING) * (missing / SMOOTHING)), scores, (c > 0).astype(np.float64)]

    table = scratch.store(bags.valued(model.words, values, 3), "word-scores")
    taken = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "uid", "rest_h", "rest_n", "s0", "s1", "s2"]
    out = bags.sums(docs.drop(*taken).withColumn("text", text), table, X.Words, 3, scratch)
    end = math.log10((model.ends + SMOOTHING) * (missing / SMOOTHING))
    known = F.round("s2").cast("long") + F.lit(int(model.ends > 0)).cast("long")
    return out.withColumns(
        {
            "n_known": known,
            "train_tokens": F.lit(n).cast("long"),
            "base_score": F.col("s0") + F.lit(end),
            "score": F.col("s1") + F.lit(model.log_end / _LN10),
            "n_tokens": F.col("n_tokens") + 1,
        }
    ).drop("s0", "s1", "s2")
