"""License scans against a plain search of every block."""

import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from flowlake.llm import licenses
from flowlake.llm.licenses import Template

SCHEMA = "doc_id long, text string, labels string, score string, block int, lang string"
PHRASES = {"gnu general public license": "gpl", "cc by": "cc-by", "one": "single"}
TEMPLATES = [
    Template("full", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "0.8"),
    Template("all", "All rights reserved"),
    Template("twice", "the rights and the copy of the rights", "0.75"),
    Template("é", "Çà et là"),
    Template("word", "reserved"),
]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(doc_id, text, templates=TEMPLATES):
    w = split(text)
    places, base, found, best = [], set(), set(), 0.0
    for phrase, label in PHRASES.items():
        p = split(phrase)
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    blocks = []
    for t in templates:
        want, size = set(split(t.text)), 1
        while size < len(split(t.text)):
            size *= 2
        for start in range(0, len(w), size):
            shared = len(want & set(w[start : start + 2 * size]))
            if shared >= Fraction(t.containment) * len(want):
                found.add(t.label)
                best = max(best, shared / len(want))
                blocks.append((doc_id, t.label, start, min(start + 2 * size, len(w)) - 1, shared / len(want)))
    row = (doc_id, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if places else best)
    return row, blocks


def corpus():
    rnd = random.Random(13)
    words = sorted({w for t in TEMPLATES for w in split(t.text)}) + ["gnu", "general", "public", "license", "cc", "by", "x1", "4", "漢字"]
    docs = [(i, "".join(rnd.choice(words) + rnd.choice([" ", "\n", "-", ". ", "\0"]) for _ in range(rnd.randint(0, 80)))) for i in range(200)]
    full = TEMPLATES[0].text
    docs += [(300, full.upper()), (301, "x " * 37 + full.replace("hereby", "")), (302, None), (303, ""), (304, " .\n"), (305, "GNU General\nPublic-License cc, by"), (None, "cc by"), (None, "cc by"), (5, "one"), (5, "one"), (306, "word " * 50_000 + "all rights reserved"), (307, "one " * 3), (308, "Ç" * 5_000)]
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "l", "s", 3, "en") for i, t in docs], SCHEMA)


@pytest.mark.parametrize("words_at_once", [licenses.GROUP_WORDS, 6])
def test_scan(spark, words_at_once, monkeypatch):
    """In one pass, and with the templates dealt to several."""
    monkeypatch.setattr(licenses, "GROUP_WORDS", words_at_once)
    docs = corpus()
    scan = licenses.LicenseScan(frame(spark, docs).repartition(3), PHRASES, TEMPLATES)
    got = scan.documents()
    assert got.columns == ["doc_id", "lang", *scan.MADE]
    want = [plain(i, t) for i, t in docs]
    assert Counter(tuple(r) for r in got.drop("lang").collect()) == Counter(row for row, _ in want)
    blocks = Counter(tuple(r) for r in scan.blocks().select("doc_id", "label", "first_word", "last_word", "share").collect())
    assert blocks == Counter(b for _, found in want for b in found)
    assert len({label for _, label, *_ in blocks}) == 5


def test_empty_tables_and_bad_templates(spark):
    assert licenses.LicenseScan(frame(spark, []), PHRASES, TEMPLATES).documents().count() == 0
    rows = licenses.LicenseScan(frame(spark, [(1, None), (2, "nothing here")]), PHRASES, TEMPLATES).documents().collect()
    assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in rows) == [(1, 0, 0, None, "", 0.0), (2, 2, 0, None, "", 0.0)]
    for bad in (Template("no words", "..."), Template("share", "a b", "1.2"), Template("share", "a b", "0")):
        with pytest.raises(ValueError):
            licenses.entries([bad])
