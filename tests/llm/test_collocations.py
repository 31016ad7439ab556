"""Phrase collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import pytest

from flowlake.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, words string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(docs, least, top, most=5, cover=100):
    f, totals = Counter(), Counter()
    for _, text, lang in docs:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for size in range(1, most + 1):
                f.update((lang, *w[i : i + size]) for i in range(len(w) - size + 1))
    frequent = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    out = {}
    for (lang, *g), a in frequent.items():
        longer = (
            b for (o, *h), b in frequent.items()
            if o == lang and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
        )
        if any(100 * b >= cover * a for b in longer):
            continue
        n = totals[lang]
        parts = [(f[lang, *g[:k]], f[lang, *g[k:]]) for k in range(1, len(g))]
        score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for k, (l, r) in enumerate(parts, 1))
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), l, r, n))
    rows = set()
    for lang, found in out.items():
        for i, (score, a, phrase, l, r, n) in enumerate(sorted(found)[:top], 1):
            rows.add((lang, i, phrase.decode(), -a, l, r, n, -score))
    return rows


def corpus():
    rnd = random.Random(11)
    words = ["the", "of", "New", "York", "city", "red", "b\x01c", "b", "é", "漢字", "a-b", "x" * 300, " "]
    fixed = ["in the city of new york", "as a matter of fact", "B b b b b b b", "b\x01c b b\x01c b"]
    docs = []
    for i in range(150):
        parts = [rnd.choice(fixed) if rnd.random() < 0.4 else " ".join(rnd.choices(words, k=rnd.randint(1, 9))) for _ in range(6)]
        docs.append((i, "".join(p + rnd.choice([". ", "\n", " ", "\t", "!?", "  ", "\x0b"]) for p in parts), rnd.choice(["en", "en", "de", None, "und", ""])))
    docs += [(1, None, "en"), (None, "", "en"), (2, " \t.\n", None), (3, "one", "fr"), (3, "one", "fr"), (4, "long text of words " * 30_000, "en")]
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, g, "p", 1, "w") for i, t, g in docs], SCHEMA)


@pytest.mark.parametrize("cover, split", [(100, False), (100, True), (60, True)])
def test_phrases(spark, cover, split):
    """Also with the streams cut into many ranges."""
    docs = corpus()
    if split:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        found = collocations.Collocations(frame(spark, docs).repartition(3), least=7, cover=cover).top(60)
        got = [tuple(r) for r in found.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = plain(docs, 7, 60, cover=cover)
    assert len(got) == len(want) > 60
    assert set(got) == want


def test_orders_and_empty_tables(spark):
    docs = [(1, "a b a b a b c", "en")] * 3
    for most in (2, 3, 7):
        got = {tuple(r) for r in collocations.Collocations(frame(spark, docs), most_words=most, least=3).top(50).collect()}
        assert got == plain(docs, 3, 50, most)
    for none in ([], [(1, None, None)], [(1, "rare words only", "en")]):
        assert collocations.Collocations(frame(spark, none), least=2).top().count() == 0


def test_scores_beyond_64_bits(spark):
    """The products of large counts are worked out exactly."""
    key, n = ["x", "y"], 3 * 10**13 + 7
    grams = spark.createDataFrame([("en", ["x"], n // 3), ("en", ["y"], n // 3 - 1), ("en", key, n // 5)], "lang string, words array<string>, n long")
    made = collocations.Collocations(frame(spark, []), least=1)
    made.grams = lambda: (grams, spark.createDataFrame([("en", n)], "lang string, total long"))
    (row,) = made.phrases().collect()
    assert row.score == 1000 * (n // 5) * n // ((n // 3) * (n // 3 - 1))
