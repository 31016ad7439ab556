"""Token alignment against whole texts encoded by both libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flowlake.llm import alignment, catalog

A_FILE, B_FILE = (str(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, uid long, radix string, data int, n_a int, lang string"


def plain(docs):
    a_tok = Tokenizer.from_file(A_FILE)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    decoder, spell = alignment.byte_decoder(), {i: t for t, i in a_tok.get_vocab().items()}
    made, counts = [], Counter()
    for doc_id, text in docs:
        whole = b" " + (text or "").encode()
        a = [(i, bytes(decoder[c] for c in spell[i])) for i in a_tok.encode(whole.decode(), add_special_tokens=False).ids] if text else []
        b = []
        for i in b_tok.encode(text) if text else []:
            p = b_tok.id_to_piece(i)
            b.append((i, bytes([int(p[3:-1], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()))
        if not text or any(b"".join(x for _, x in side) != whole for side in (a, b)):
            made.append((doc_id, 0, 0, [], ""))
            continue
        ends = []
        for side in (a, b):
            at, found = 0, {}
            for k, (_, x) in enumerate(side):
                at += len(x)
                found[at] = k
            ends.append(found)
        both = sorted(ends[0].keys() & ends[1].keys())
        links = [(a[ends[0][e]][0], b[ends[1][e]][0]) for e in both]
        x = y = 0
        groups = []
        for e in both:
            i, j = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(str(t) for t, _ in a[x:i]) + "|" + ",".join(str(t) for t, _ in b[y:j]))
            x, y = i, j
        counts.update(links)
        made.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return Counter(
        (i, n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha)
        for i, n_a, n_b, links, sha in made
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def corpus():
    rnd = random.Random(12)
    words = ["the", "of", "New", "York's", "don't", "naïve", "漢字", "かな", "é", "12345", "x" * 50, "<s>", "</s>", "<unk>", "<0x0A>", "<|endoftext|>", "🙂", "a b", "　", "é", "\x00", "\x1c", "\u0085", " "]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "   ", " ", "　 ", "'", ".", "", "\x0b "]
    docs = []
    for i in range(120):
        docs.append((i, "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.randint(1, 60)))))
    docs += [(200, None), (201, ""), (202, " "), (203, "\n"), (204, "a "), (205, " a"), (206, "  "), (207, "a▁b c"), (208, "▁"), (209, "a \n b \n"), (None, "no id"), (None, "no id"), (5, "twice"), (5, "twice"), (210, "word " * 40_000), (211, "unbroken" * 3_000)]
    return docs


@pytest.fixture(scope="module")
def frame(spark):
    return lambda docs: spark.createDataFrame([(i, t, 7, "r", 1, 2, "en") for i, t in docs], SCHEMA)


def test_alignment(frame):
    docs = corpus()
    got = alignment.Alignment(frame(docs).repartition(3), A_FILE, B_FILE).documents()
    assert got.columns[:1] == ["doc_id"] and "lang" in got.columns
    assert Counter(tuple(r) for r in got.select(COLUMNS).collect()) == plain(docs)


def test_salted_groups_and_small_blocks(frame, monkeypatch):
    """A hot pair's records in many blocks and salted partitions."""
    docs = [(i, "the same words of the text the the the\n" + "the " * (i % 7)) for i in range(300)]
    monkeypatch.setattr(alignment, "GROUP_BYTES", 300)
    made = alignment.Alignment(frame(docs).repartition(5), A_FILE, B_FILE)
    assert made._groups()[1].agg({"salts": "max"}).first()[0] > 3
    assert Counter(tuple(r) for r in made.documents().select(COLUMNS).collect()) == plain(docs)


def test_merge_in_small_steps(monkeypatch):
    """The heap merge gives all records in order of their pair, whatever blocks they come in."""
    import numpy as np

    monkeypatch.setattr(alignment, "BLOCK", 16)
    monkeypatch.setattr(alignment, "_MERGED", 40)
    rng = np.random.default_rng(3)
    blocks, every = [], []
    for run in range(9):
        pairs = np.sort(np.where(rng.random(200) < 0.4, 77, rng.integers(0, 150, 200)))
        columns = [pairs, np.arange(200) + 1_000 * run, rng.integers(1, 5, 200)]
        every += list(zip(*(c.tolist() for c in columns), strict=True))
        blocks += [(1, *row[2:]) for row in alignment._blocks(columns, np.zeros(200, np.int64), run)]
    known = np.unique([p for p, _, _ in every])
    blocks += [(0, *row[2:]) for row in alignment._blocks([known, known * 10, known % 2], np.zeros(len(known), np.int64), -1)]
    blocks.sort(key=lambda r: (r[1], r[0]))
    out = []
    for pairs, docs, times, (at, count, _) in alignment._merged(iter(blocks)):
        assert (count[np.searchsorted(at, pairs)] == 10 * pairs).all()
        out += list(zip(pairs.tolist(), docs.tolist(), times.tolist(), strict=True))
    assert [r[0] for r in out] == sorted(r[0] for r in out)
    assert sorted(out) == sorted(every)


def test_no_texts(frame):
    for docs in ([], [(1, None), (2, "")]):
        got = alignment.Alignment(frame(docs), A_FILE, B_FILE).documents().select(COLUMNS).collect()
        assert Counter(tuple(r) for r in got) == plain(docs)


def test_registered_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = catalog.op12_tokenizer_alignment(spark, sf_dir)
    assert Counter(tuple(r) for r in got.select(COLUMNS).collect()) == plain(docs)
