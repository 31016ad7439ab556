"""URL filter: rules first, then the ratio of two character language models.

Two smoothed Markov models of variable order, one of accepted and one of rejected URLs, learn from the URLs
that the rules decide. Longer contexts are used as far as they were seen; each order is smoothed with the
next shorter one. A URL that no rule decides is judged by the difference of its two log-likelihoods per
character, against a threshold calibrated on a fold that the models did not learn from.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm import bags
from flowlake.llm import textops as X
from flowlake.llm.scratch import Scratch

#: Longest context, in bytes.
ORDER = 4
#: Weight of the next shorter context.
KAPPA = 2.0
#: Share of the rule-decided URLs kept for calibration, one in so many.
FOLD = 5
_BINS, _SPAN = 2000, 10.0
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    """Holds for a host and all its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parsed(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; both are empty without ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return df.withColumns({"host": F.translate(host, _UPPER, _UPPER.lower()), "path": path})


def ruled(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``rule`` (host and path of the longest rule that fits) and ``decided`` (its verdict), null without."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest fit wins, then the earlier rule: put the winner outermost.
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return df.withColumns({"rule": name, "decided": verdict})


class _Grams:
    """For every byte of the texts and the end of each: the byte with the ``ORDER`` bytes before it, as one number."""

    def __init__(self, texts: list):
        parts = [b"\x00" * ORDER + bytes(t) + b"\x01" for t in texts]
        buf = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
        sizes = np.array([len(p) for p in parts])
        within = np.arange(len(buf)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.flatnonzero(within >= ORDER)
        self.counts = sizes - ORDER
        self.hashes = sum(buf[place - k] << np.uint64(8 * k) for k in range(ORDER + 1))


def _counted(batches):
    """accepted, url -> accepted, distinct grams and how often they occur."""
    for batch in batches:
        texts, accepted = X.raw_texts(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
        for a, b in X.pieces(texts):
            grams = _Grams(texts[a:b])
            code, n = np.unique((grams.hashes << np.uint64(1)) | np.repeat(accepted[a:b], grams.counts), return_counts=True)
            kind = pa.array((code & np.uint64(1)).astype(bool))
            yield pa.record_batch([kind, pa.array(X.signed(code >> np.uint64(1))), pa.array(n)], ["accepted", "g", "n"])


def _exploded(grams: DataFrame, orders, *others: str) -> DataFrame:
    """Per gram and order two rows: ``slot, code`` of its context and of context and byte."""
    slots = []
    for k in orders:
        full = F.col("g").bitwiseAND((1 << 8 * (k + 1)) - 1)
        slots += [F.struct(F.lit(2 * k + i).alias("slot"), c.alias("code")) for i, c in enumerate((F.shiftright(full, 8), full))]
    return grams.select("g", *others, F.explode(F.array(*slots)).alias("s")).select("g", *others, "s.slot", "s.code")


class UrlModel:
    """Models of accepted and rejected URLs. ``threshold`` is None when one of them has no examples."""

    def __init__(self, examples: DataFrame):
        """``examples(url, accepted)``: host and path of URLs whose verdict is known."""
        self.scratch = Scratch(examples.sparkSession, "urls")
        fold = F.pmod(F.xxhash64("url"), F.lit(FOLD)) == 0
        counted = examples.where(~fold).select("accepted", "url").mapInArrow(_counted, "accepted boolean, g long, n long")
        sums = [F.sum(F.when(F.col("accepted") == bool(i), F.col("n")).otherwise(0)).alias(f"n{i}") for i in (0, 1)]
        seen = self.scratch.store(counted.groupBy("g").agg(*sums), "grams")
        codes = _exploded(seen, range(ORDER + 1), "n0", "n1").groupBy("slot", "code").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        self.counts = self.scratch.store(codes, "counts")
        self.threshold = None
        if all(seen.agg(F.sum("n0"), F.sum("n1")).first()):
            self.threshold = self._calibrated(examples.where(fold)) or 0.0

    def _calibrated(self, examples: DataFrame) -> float | None:
        """The middle of the thresholds with the best mean of both classes' accuracies."""
        place = F.floor((F.col("ratio") + _SPAN) / (2 * _SPAN) * _BINS)
        bins = self.scored(examples).groupBy("accepted", F.greatest(F.lit(0), F.least(F.lit(_BINS - 1), place)).alias("bin")).count()
        hist = np.zeros((2, _BINS))
        for row in bins.collect():  # two rows per bin at most
            hist[int(row.accepted), row.bin] = row["count"]
        if not hist.sum(axis=1).all():
            return None
        share = hist / hist.sum(axis=1, keepdims=True)
        below = np.cumsum(share, axis=1)
        right = below[0] - below[1]  # rejected below the border less accepted below it
        best = np.flatnonzero(right == right.max())
        return (best.mean() + 1) / _BINS * 2 * _SPAN - _SPAN

    def _valued(self, grams: DataFrame) -> DataFrame:
        """``g, n`` to ``h, n, v0``: the log-likelihood of the last byte as accepted less that as rejected."""
        # Orders 0 and 1 have at most 66,049 counters; they are sent, as their contexts are in many grams.
        low = _exploded(grams, (0, 1)).join(F.broadcast(self.counts.where("slot < 4")), ["slot", "code"])
        high = _exploded(grams, range(2, ORDER + 1)).join(self.counts.where("slot >= 4"), ["slot", "code"])
        name = lambda slot, i: f"c{slot}_{i}"
        each = [F.sum(F.when(F.col("slot") == s, F.col(f"n{i}"))).alias(name(s, i)) for s in range(2 * ORDER + 2) for i in (0, 1)]
        found = grams.join(low.unionByName(high).groupBy("g").agg(*each), "g", "left")
        log_p = []
        for i in (0, 1):
            p = F.lit(1 / 256)
            for k in range(ORDER + 1):
                context, full = (F.coalesce(name(2 * k + j, i), F.lit(0)) for j in (0, 1))
                p = (full + KAPPA * p) / (context + KAPPA)
            log_p.append(F.log(p))
        return found.select(F.col("g").alias("h"), "n", (log_p[1] - log_p[0]).alias("v0"))

    def scored(self, df: DataFrame) -> DataFrame:
        """Add ``ratio``: log-likelihood per character as accepted less that as rejected."""
        kept = [c for c in df.columns if c != "ratio"]
        grams = df.select(F.lit(True), F.col("url").cast("string")).mapInArrow(_counted, "accepted boolean, g long, n long")
        grams = self.scratch.store(grams.groupBy("g").agg(F.sum("n").alias("n")), "wanted")
        table = self.scratch.store(self._valued(grams), "values")
        rows = df.select(F.struct(*kept).alias("row"), F.col("url").cast("string").alias("text"))
        return bags.sums(rows, table, _Grams, 1, self.scratch).select("row.*", (F.col("s0") / F.col("n_tokens")).alias("ratio"))


def judged(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, ratio`` for every row of ``pages(page_id, url)``.

    ``verdict`` is the longest fitting rule's, else that of the models learned from the URLs the rules decide, whole
    as they are, with scheme, query and fragment:
    allow when ``ratio`` reaches the calibrated threshold. A null url, or one without ``://``, has an empty
    host and path and is judged by the models like any other. Without examples of both verdicts the rest is allowed.
    Rows without or with repeated ids are judged each by its url; other columns are not looked at.
    """
    rows = ruled(parsed(pages.select("page_id", "url")), rules)
    examples = rows.where("decided IS NOT NULL").select("url", (F.col("decided") == "allow").alias("accepted"))
    model = UrlModel(examples)
    guess = F.lit("allow")
    if model.threshold is not None:
        guess = F.when(F.col("ratio") >= model.threshold, "allow").otherwise("block")
    out = model.scored(rows)
    return out.select("page_id", "host", "path", "rule", F.coalesce("decided", guess).alias("verdict"), "ratio")
