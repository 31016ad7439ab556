"""Every text operator against a plain version, with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import io
import math
import random
import zlib

import pytest
from llm import brute
from pyspark.sql import functions as F

from flowlake.llm import catalog, contamination, embeddings, lattice, line_dedup, minhash, mixing, token_counts, toxicity, urls, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, uid long, score double, cid string"


def texts():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 120))) for _ in range(40)]
    out = list(base)
    for t in base[:20]:  # near copies: a few words changed
        w = t.split()
        for _ in range(2):
            w = list(w)
            w[rnd.randrange(len(w))] = "changed"
            out.append(" ".join(w).upper())
    out += base[:5] + [None, "", " \t\n", "one", "one", "a b c", "a b c", "line one of the text here\nline one of the text here\n", "x" * 100_000]
    out += ["\n".join([base[0], base[1], "short"]), " ".join(base[2:30])]
    return list(enumerate(out))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 4}" if (i or 0) % 7 else None, 1, 9, 0.5, "z") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, texts())


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(docs):
    sets, want = brute.near_copies(texts(), 4)
    rows = minhash.near_duplicates(docs, width=4).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows} == {(i, len(sets[i]), c, c == i) for i, c in want.items()}
    assert len(rows) == len(sets)


def test_near_duplicates_without_ids_and_with_repeats(spark, none):
    long = " ".join(f"w{i}" for i in range(50))
    rows = frame(spark, [(None, long), (None, long), (7, long), (7, long), (7, "other words stand in this text"), (8, "other words stand in this text"), (9, None)])
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(rows).collect()}
    assert got == {(None, None, True), (7, 7, True), (8, 7, False), (9, 9, True)}
    assert sorted((r.doc_id is None, r.doc_id) for r in minhash.without_copies(rows).collect() if r.doc_id) == [(False, 7), (False, 9)]
    assert minhash.without_copies(rows).where("doc_id IS NULL").count() == 2
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.without_copies(none).columns == none.columns


def test_group_whose_members_hang_together_by_chains(spark):
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):  # each text differs a little more from the first
        words = [*words[:i], f"c{i}", *words[i + 1 :]]
        rows.append((i, " ".join(words)))
    _, want = brute.near_copies(rows, 5)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == want


def test_contamination(spark, docs, none):
    base = [t for _, t in texts()]
    items = [(1, base[3]), (2, base[4] + " and more words that are nowhere at all in any text"), (3, None), (4, ""), (5, "a b c"), (6, base[7].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contaminated(texts(), items)
    found = contamination.Contamination(docs, bench)
    assert {(r.doc_id, r.item_id) for r in found.pairs().collect()} == want
    left = contamination.Contamination(docs, bench).clean()
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in texts()} - {d for d, _ in want}
    assert contamination.Contamination(none, bench).pairs().count() == 0
    assert contamination.Contamination(docs, bench.where("item_id IN (3, 4)")).clean().count() == docs.count()


def test_vectors(spark):
    rnd = random.Random(3)
    rows, groups = [], []
    for i in range(30):
        v = [rnd.gauss(0, 1) for _ in range(16)]
        groups.append(v)
        rows += [(4 * i + k, [x + rnd.gauss(0, 0.08) for x in v]) for k in range(3)] + [(4 * i + 3, v)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16), (905, groups[0]), (905, groups[0]), (None, groups[0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() if r.vec_id is not None}

    def close(a, b):
        dot = sum(x * y for x, y in zip(a, b, strict=True))
        return dot / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b)) >= 0.9

    sound = [(i, v) for i, v in rows if i is not None and i not in range(900, 905)]
    links = [(a, b) for n, (a, x) in enumerate(sound) for b, y in sound[n + 1 :] if close(x, y)]
    parts = brute.groups({i for i, _ in sound}, links)
    for n, (i, x) in enumerate(sound):
        count = sum(close(x, y) for m, (_, y) in enumerate(sound) if m != n)
        assert got[i] == (count, parts[i])
    assert all(got[i] == (0, i) for i in range(900, 905))


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (3, None, None), (4, "u", ""), (None, "n", "<p>é</p>"), (5, "line\r\nbreak", "x" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    files = warc.write_warc(df, f"{tmp_path}/warc")
    rows = {r.page_id: r for r in warc.read_warc(files).collect()}
    for i, _, html in pages:
        data = (html or "").encode()
        assert rows[i].payload_bytes == len(data)
        assert rows[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert {i: (r.record_type, r.refers_to) for i, r in rows.items()} == {
        1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("revisit", 3), None: ("revisit", 1), 5: ("response", None)
    }
    assert bytes(rows[5].payload) == b"x" * 300_000 and rows[2].payload is None
    assert warc.read_warc(warc.write_warc(df.limit(0), f"{tmp_path}/none")).count() == 0


def test_warc_refuses_damaged_records():
    good = warc.page_record(1, "u", b"payload", None)
    assert len(list(warc.read_records(io.BytesIO(good + good)))) == 2
    changed = zlib.decompress(good, 31).replace(b"payload", b"payl0ad")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(ValueError, match="does not match"):
        list(warc.read_records(io.BytesIO(packer.compress(changed) + packer.flush())))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.read_records(io.BytesIO(good[:-9])))


def test_lattice_counts_every_segmentation():
    import numpy as np

    pieces = [bytes([b]) for b in range(256)] + [b" a", b"ab", b" ab", b"b"[:0] + b"bb"]
    p = np.random.default_rng(1).random(len(pieces))
    p /= p.sum()
    vocab, value = lattice.Vocabulary(pieces, np.log(p)), dict(zip(pieces, p, strict=True))

    def whole(word):
        return sum(value[word[:k]] * whole(word[k:]) for k in range(1, len(word) + 1) if word[:k] in value) if word else 1.0

    for word in (b" a", b" ab", b" abb", b" abbab", b" b"):
        assert lattice.log10_marginals(vocab, [word])[0] == pytest.approx(math.log10(whole(word)))
    long = b" " + b"ab" * 90
    assert lattice._long_forward(vocab, long) == pytest.approx(lattice._forward(vocab, next(iter([lattice._found(vocab, np.frombuffer(long, np.uint8)[None, :])])), 1, len(long))[-1][0])


def test_lattice_scores(docs, none):
    train = F.col("doc_id") % 5 != 0
    rows = lattice.lattice_scores(docs, train, catalog._tokenizer()).collect()
    tokens = {i: [*brute.words(t), "\n"] for i, t in texts()}
    counts = {}
    for i, w in tokens.items():
        for x in w if i % 5 else []:
            counts[x] = counts.get(x, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        w = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in counts for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        assert r.score < 0
    assert len(rows) == len(tokens)
    assert lattice.lattice_scores(none, train, catalog._tokenizer()).count() == 0


def test_lattice_learns_from_long_words(spark, monkeypatch):
    import numpy as np
    from flowlake.llm.scratch import Scratch

    rnd = random.Random(4)
    word = "".join(rnd.choice(["the", "ing", "x7", "\u6f22", "\u5b57", "\u00e9", "q"]) for _ in range(6_000)).encode()[:9_999].decode(errors="ignore")
    chars = np.frombuffer(b" " + word.encode(), np.uint8)[None, :]
    pieces, weights = lattice.read_pieces(catalog._tokenizer())
    log_p = np.log(weights)
    for _ in range(lattice.STEPS):
        total = np.zeros(len(pieces) + 1)
        lattice._add_expected(lattice.Vocabulary(pieces, log_p), chars, np.ones(1), total)
        counts = total[:-1] + lattice.SMOOTHING
        log_p = np.log(counts / (counts.sum() + 1 + lattice.SMOOTHING))
    model = lattice._Trained(spark.createDataFrame([(word, True)], "text string, chosen boolean"), catalog._tokenizer(), Scratch(spark, "test"))
    assert chars.size > 9_990 and model.log_p == pytest.approx(log_p)
    monkeypatch.setattr(lattice, "_WINDOW", 1_000)
    vocab, plain = lattice.Vocabulary(pieces, log_p), np.zeros(len(pieces) + 1)
    lattice._add_expected(vocab, chars, np.full(1, 3.0), plain)
    assert lattice.expected_counts(vocab, [chars.tobytes()], np.full(1, 3.0)) == pytest.approx(plain[:-1])


def test_urls(spark):
    rows = [
        (1, "http://x.ORG/a?b#c", "x.org", "/a", "org/", "allow"), (2, "https://www.example.org/es/1", "www.example.org", "/es/1", "example.org/es/", "block"),
        (3, "http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"), (4, "http://a.com/de/", "a.com", "/de/", "com/de/", "block"),
        (5, "http://a.com/fr/x", "a.com", "/fr/x", "com/fr/", "allow"), (6, "http://xorg/a", "xorg", "/a", None, None), (7, None, "", "", None, None),
        (8, "no scheme.org/", "", "", None, None), (9, "http://b.org#x/y", "b.org", "", None, None), (None, "http://b.org/://", "b.org", "/://", "org/", "allow"),
    ]
    got = {r.page_id: r for r in urls.judged(spark.createDataFrame([r[:2] for r in rows], "page_id long, url string"), catalog.URL_RULES).collect()}
    for i, _, host, path, rule, verdict in rows:
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict or verdict is None and got[i].verdict in ("allow", "block")


def test_urls_are_judged_whole(spark):
    """Scheme, query, fragment and urls without a host tell undecided urls apart."""
    rows = [(i, f"http://a{i}.org/page?read={i}") for i in range(300)] + [(1_000 + i, f"ftp://a{i}.com/de/page?track=ad{i}#x") for i in range(300)]
    rows += [(5_000, "http://b.net/page?read=77"), (5_001, "ftp://b.net/page?track=ad77#x"), (5_002, "page?read=5"), (5_003, "track=ad9#x"), (5_004, None), (5_005, "")]
    got = {r.page_id: r for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string"), catalog.URL_RULES).collect()}
    assert [got[i].verdict for i in range(5_000, 5_004)] == ["allow", "block", "allow", "block"]
    assert got[5_004].ratio == got[5_005].ratio and got[5_004].host == got[5_005].host == ""
    none = spark.createDataFrame([], "page_id long, url string, host string")
    assert urls.judged(none, catalog.URL_RULES).count() == 0


def test_url_models_part_accepted_from_rejected(spark):
    good = [(f"http://good.org/article/story-{i}", True) for i in range(300)]
    bad = [(f"http://cheap-pills{i}.xyz/buy?now", False) for i in range(300)]
    model = urls.UrlModel(spark.createDataFrame(good + bad, "url string, accepted boolean"))
    judged = model.scored(spark.createDataFrame(good + bad, "url string, accepted boolean"))
    assert judged.where((F.col("ratio") >= model.threshold) == F.col("accepted")).count() == 600


def test_url_models_count_every_context(spark, monkeypatch):
    monkeypatch.setattr(urls.bags, "FREQUENT", 1_000)  # the other grams are joined
    rnd = random.Random(8)
    rows = [("x.org/" + "".join(rnd.choice("0123456789abcdefghijklmnopqrstuvwxyz%-_ABCDEF\u00e9") for _ in range(40)), i % 2 == 0) for i in range(2_500)] + [("", True)]
    df = spark.createDataFrame(rows, "url string, accepted boolean")
    fitted = {r.url for r in df.where(F.pmod(F.xxhash64("url"), F.lit(urls.FOLD)) != 0).collect()}
    counts = {True: {}, False: {}}

    def spans(url):
        b = b"\0" * 4 + url.encode() + b"\1"
        return [b[j - 4 : j + 1] for j in range(4, len(b))]

    for url, accepted in rows:
        for g in spans(url) if url in fitted else []:
            for k in range(5):
                for key in ((0, k, g[4 - k : 4]), (1, k, g[4 - k :])):
                    counts[accepted][key] = counts[accepted].get(key, 0) + 1
    assert len({key for c in counts.values() for key in c if key[:2] == (0, 4)}) > 1 << 16

    def log_p(g, c):
        p = 1 / 256
        for k in range(5):
            p = (c.get((1, k, g[4 - k :]), 0) + urls.KAPPA * p) / (c.get((0, k, g[4 - k : 4]), 0) + urls.KAPPA)
        return math.log(p)

    got = {r.url: r.ratio for r in urls.UrlModel(df).scored(df).collect()}
    for url, _ in rows[-300:]:
        grams = spans(url)
        assert got[url] == pytest.approx(sum(log_p(g, counts[True]) - log_p(g, counts[False]) for g in grams) / len(grams), abs=1e-9)


def test_token_counts(spark, docs, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=catalog._tokenizer())
    odd = [(500, "  lead  and trail "), (501, "\n\n"), (502, "a▁b ▁ c"), (503, "<s> \r\n\t</s>"), (504, "ﬁ é é 漢字 😀")]
    both = docs.unionByName(frame(spark, odd))
    for r in token_counts.token_counts(both, catalog._tokenizer()).collect():
        text = dict([*texts(), *odd])[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(sp.encode(text)))
    assert token_counts.token_counts(none, catalog._tokenizer()).count() == 0


def test_mix(docs, none):
    rows = mixing.Mix(docs, block=50).documents().collect()
    sizes = {i: len(brute.words(t)) for i, t in texts()}
    assert {r.doc_id: r.size for r in rows} == sizes
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    ranked = sorted(by, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(ranked)}
    size = {s: sum(r.size for r in by[s]) for s in by}
    target, left, full = {}, 1.5 * sum(size.values()), set()
    while True:  # the rule, round by round
        rest = [s for s in by if s not in full]
        target = {s: 2.0 * size[s] if s in full else (left - sum(2 * size[f] for f in full)) * weight[s] / sum(weight[x] for x in rest) for s in by}
        over = {s for s in rest if target[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    for s, group in by.items():
        assert group[0].target == pytest.approx(target[s])
        assert abs(sum(r.taken for r in group) - target[s]) <= 1
    again = mixing.Mix(docs.repartition(5), block=50).documents()
    assert {(r.doc_id, r.taken) for r in again.collect()} == {(r.doc_id, r.taken) for r in rows}
    assert mixing.Mix(none).documents().count() == 0


def test_toxicity_on_held_out_texts(spark, none):
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        w = [f"w{rnd.randrange(300)}" for _ in range(rnd.randint(5, 60))]
        toxic = i % 3 == 0
        rows.append((i, " ".join(w + ["Idiot", "scum"] * toxic), int(toxic)))
    rows += [(1000, None, None), (1001, "", 0), (None, "idiot", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.Toxicity(df.where("doc_id % 2 = 0"))
    scored = model.scored(df.where("doc_id % 2 = 1").withColumn("score", F.lit("kept")), into="p").collect()
    assert all((r.p >= 0.7) == bool(r.label) for r in scored if r.text) and {r.score for r in scored} == {"kept"}
    assert all(0 <= r.score <= 1 for r in model.scored(df).collect())
    assert {r.score for r in toxicity.Toxicity(none.select("doc_id", "text", F.lit(1).alias("label"))).scored(df).collect()} == {0.5}


def test_line_dedup(docs, none):
    got = {(r.doc_id, k) for r in line_dedup.report(docs).collect() for k in r.removed_lines}
    assert got == brute.late_lines(texts())
    cleaned = {r.doc_id: r.text for r in line_dedup.clean(docs).collect()}
    for i, text in texts():
        gone = {k for d, k in got if d == i}
        kept = [x for k, x in enumerate((text or "").split("\n")) if k not in gone]
        if not gone:
            assert cleaned[i] == text
        elif any(brute.words(x) for x in kept):
            assert cleaned[i] == "\n".join(kept)
        else:
            assert i not in cleaned
    assert line_dedup.clean(docs).columns == docs.columns
    assert line_dedup.report(none).count() == 0 and line_dedup.clean(none).count() == 0


@pytest.mark.parametrize("most_sent", [0, 1 << 19])
def test_line_dedup_by_earliest_lines_first(spark, monkeypatch, most_sent):
    monkeypatch.setattr(line_dedup, "FEW", 0)
    monkeypatch.setattr(line_dedup, "MOST_SENT", most_sent)
    base = [f"w{i}" for i in range(12)]
    rows = texts() + [(1000 + i, " ".join([*base[:-1], f"v{i}"])) for i in range(30)]  # near to the base, not always to one another
    rows += [(900, " ".join(base)), (2000, " ".join([*base[:-2], "v1", "v2"]))]
    got = {(r.doc_id, k) for r in line_dedup.report(frame(spark, rows)).collect() for k in r.removed_lines}
    assert got == brute.late_lines(rows)


def test_line_dedup_by_cells_of_common_words(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MANY", 0)
    monkeypatch.setattr(line_dedup, "SETTLED", 1)
    got = {(r.doc_id, k) for r in line_dedup.report(frame(spark, texts())).collect() for k in r.removed_lines}
    assert got == brute.late_lines(texts())


def test_line_dedup_proposes_no_long_unlike_lines(spark, monkeypatch):
    rnd, proposed, store = random.Random(4), [], line_dedup.Scratch.store

    def stored(self, df, name):
        table = store(self, df, name)
        if name == "candidates":
            proposed.append(table.count())
        return table

    monkeypatch.setattr(line_dedup.Scratch, "store", stored)
    rows = [(i, " ".join(rnd.sample([f"w{k}" for k in range(6000)], 140))) for i in range(400)]
    rows.append((1000, rows[7][1] + " more"))
    got = {(r.doc_id, k) for r in line_dedup.report(frame(spark, rows)).collect() for k in r.removed_lines}
    assert got == {(1000, 0)} and 1 <= sum(proposed) < 40


def _candidates(monkeypatch):
    """The numbers of pairs that are proposed from here on."""
    proposed, store = [], line_dedup.Scratch.store

    def stored(self, df, name):
        table = store(self, df, name)
        if name == "candidates":
            proposed.append(table.count())
        return table

    monkeypatch.setattr(line_dedup.Scratch, "store", stored)
    return proposed


def test_line_dedup_proposes_few_pairs_of_a_group_of_near_copies(spark, monkeypatch):
    proposed, base = _candidates(monkeypatch), [f"w{i}" for i in range(20)]
    rows = [(i, " ".join([*base, f"v{i}"])) for i in range(200)] + [(900 + i, f"v{i} x{i}") for i in range(200)]
    got = {(r.doc_id, k) for r in line_dedup.report(frame(spark, rows)).collect() for k in r.removed_lines}
    assert got == {(i, 0) for i in range(1, 200)}
    assert sum(proposed) <= 200 * 5  # of 19,900


@pytest.mark.parametrize("few", [1, 1 << 10])
def test_line_dedup_of_open_lines(spark, monkeypatch, few):
    """Long lines about as similar as the threshold: the nearest ones by parities often fail."""
    monkeypatch.setattr(line_dedup, "FEW", few)
    monkeypatch.setattr(line_dedup, "NEAREST", 1)
    proposed, rnd, rows = _candidates(monkeypatch), random.Random(8), []
    for g in range(3):
        base = [f"w{g}x{k}" for k in range(200)]
        for i in range(25):
            gone = set(rnd.sample(range(200), rnd.randrange(16, 32)))
            words = [w if k not in gone else f"n{g}x{i}x{k}" for k, w in enumerate(base)]
            rows.append((rnd.choice([100 * g + i, 7]), " ".join(words)))
    got = [(r.doc_id, r.n_lines, tuple(r.removed_lines)) for r in line_dedup.report(frame(spark, rows)).collect()]
    assert len(proposed) == 2 and proposed[1] > 0
    late = 0
    place = {r.text: r.p for r in frame(spark, rows).selectExpr("text", "xxhash64(text) AS p").collect()}
    ranked = sorted(rows, key=lambda r: (r[0], place[r[1]]))
    for n, (_, text) in enumerate(ranked):
        mine = set(text.split())
        late += any(5 * len(mine & set(t.split())) >= 4 * len(mine | set(t.split())) for _, t in ranked[:n])
    assert sum(len(removed) for _, _, removed in got) == late


def test_line_dedup_of_open_lines_by_cells_of_common_words(spark, monkeypatch):
    """The words looked for in the second reading are known by the keys of their cells only."""
    for name, value in (("MANY", 0), ("NEAREST", 1), ("SETTLED", 1)):
        monkeypatch.setattr(line_dedup, name, value)
    proposed, rnd, rows = _candidates(monkeypatch), random.Random(8), texts()
    for i in range(25):
        gone = set(rnd.sample(range(200), rnd.randrange(16, 32)))
        rows.append((5000 + i, " ".join(w if k not in gone else f"n{i}x{k}" for k, w in enumerate(f"w{k}" for k in range(200)))))
    got = {(r.doc_id, k) for r in line_dedup.report(frame(spark, rows)).collect() for k in r.removed_lines}
    assert len(proposed) == 2 and proposed[1] > 0 and got == brute.late_lines(rows)


def test_second_reading_of_line_dedup_looks_at_lines_with_wanted_words_only(monkeypatch):
    from fractions import Fraction
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    from flowlake.llm import bitset, textops

    def bits(hashes):
        flags = np.zeros(1 << bitset.BITS, dtype=bool)
        flags[(np.asarray(hashes, dtype=np.uint64) >> np.uint64(64 - bitset.BITS)).astype(np.int64)] = True
        return SimpleNamespace(value=np.packbits(flags))

    rnd, sorted_words, by_line = random.Random(6), [], line_dedup._by_line
    lines = [" ".join(rnd.sample([f"w{k}" for k in range(3000)], 20)) for _ in range(2000)]
    batch = pa.record_batch([pa.array(range(200)), pa.array(range(200)), pa.array(["\n".join(lines[i::200]) for i in range(200)])], ["doc_id", "place", "text"])
    words = np.sort(textops.Words([f"w{k}".encode() for k in range(3000)]).hashes)  # the first ones lead in prefixes
    few, none = words[[5, 70, 900]], np.zeros(0, np.uint64)
    ranked, hot = SimpleNamespace(value=(none, none.astype(np.uint32))), SimpleNamespace(value=(none, none.view(np.int64), none.view(np.int64)))
    monkeypatch.setattr(line_dedup, "_by_line", lambda line, key, n: sorted_words.append(len(key)) or by_line(line, key, n))

    def rows(common, *probed):
        sorted_words.clear()
        many, found = bits(words[:50] if common else none), set()
        keys = line_dedup._cell(line_dedup._half(words[:1]), np.uint64(2), np.uint64(3)) if common else line_dedup._half(few)
        wanted = bits(keys.astype(np.uint64) << np.uint64(32))
        if probed:
            column = pa.record_batch([pa.array(words.view(np.int64))], ["word"])
            held = [w for b in line_dedup._probing(many, wanted)([column]) for w in b.column(0).to_numpy().view(np.uint64).tolist()]
            assert set(held) == set((words[:1] if common else few).tolist())
            probed = [bits(held)]
        for b in line_dedup._blocks(5, Fraction("0.8"), ranked, bits(words), hot, many, wanted, *probed)([batch]):
            for _, n, base, near, small, blob in zip(*(c.to_pylist() for c in b.columns)):
                found |= set(zip(*(c.tolist() for c in line_dedup._columns(n, base, near, small, memoryview(blob)))))
        return found, sum(sorted_words)

    for common in (False, True):
        (whole, all_words), (got, some_words) = rows(common), rows(common, True)
        assert got == whole and len(got) > 0 and some_words < all_words / 10


def test_line_dedup_counts_words_of_several_batches():
    import numpy as np
    import pyarrow as pa

    batch = lambda *texts: pa.record_batch([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "place", "text"])
    out = list(line_dedup._listed(1, 2)([batch("a b a\nb c\nc", None, "d a"), batch(""), batch("d e\nf")]))
    packed = [r for b in out for r in b.to_pylist() if r["block"] is not None]
    blocks = pa.Table.from_pylist(sorted(packed, key=lambda r: r["block"])).select(["block", "words", "counts"]).to_batches()
    got = {(w, n) for b in line_dedup._summed(blocks) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    from flowlake.llm import textops

    a, b, d = textops.Words([b"a", b"b", b"d"]).hashes.view(np.int64).tolist()
    assert got == {(a, 2), (b, 2), (d, 2)}


def test_bit_table_takes_one_row_per_block():
    import numpy as np
    import pyarrow as pa

    from flowlake.llm import bitset

    places = np.arange(0, 3 * bitset._BLOCK, 5, dtype=np.int32)
    out = list(bitset._packed(pa.record_batch([pa.array(places[k::4])], ["p"]) for k in range(4)))
    assert sorted(b.column(0)[0].as_py() for b in out) == [0, 1, 2]
    assert sum(np.unpackbits(np.frombuffer(b.column(1)[0].as_py(), np.uint8)).sum() for b in out) == len(places)


def test_line_dedup_of_rows_out_of_order(spark):
    copy = [f"w{i}" for i in range(12)]
    near = [" ".join([*copy[:-1], f"v{i}"]) for i in range(3)]
    copy, rnd = " ".join(copy), random.Random(3)
    rows = [(50, copy), (40, near[0]), (30, f"{copy}\n{near[1]}"), (20, f"other words of no copy at all\n{copy}"), (3, copy), (2, near[2])]
    for _ in range(3):  # all rows in one batch
        got = {(r.doc_id, k) for r in line_dedup.report(frame(spark, rows).coalesce(1)).collect() for k in r.removed_lines}
        assert got == brute.late_lines(rows)
        rnd.shuffle(rows)


def test_registered_line_dedup_takes_short_lines(spark, tmp_path):
    rows = [(1, "Heading\na b c d\n\n \na b c"), (2, "a b c d e\nheading\n" + "x y " * 60), (3, "y x\nc b a\na b"), (4, "\u6f22\u5b57" * 40), (5, "\u6f22\u5b57" * 40)]
    rows += [(i + 10, t) for i, t in texts()]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, k) for r in catalog.op10_line_dedup(spark, str(tmp_path)).collect() for k in r.removed_lines}
    assert got == brute.late_lines(rows, 1)
    assert {(2, 0), (2, 1), (3, 0), (3, 1), (5, 0)} <= got


def test_line_dedup_keeps_one_of_repeated_rows(spark):
    rows = frame(spark, [(1, "these words stand in a line"), (1, "these words stand in a line"), (None, "these words stand in a line")])
    assert [r.doc_id for r in line_dedup.clean(rows).collect()] == [1]


def test_pipeline_against_plain_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    order = [name for name, _ in corpus_pipeline.STAGES]
    assert order == ["toxicity", "line dedup", "near-duplicate documents", "benchmark decontamination", "source mix"]
    stage = dict(corpus_pipeline.STAGES)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    _, groups = brute.near_copies(plain, 5)
    kept = stage["near-duplicate documents"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, c in groups.items() if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute.contaminated(plain, items)}
    assert {r.doc_id for r in stage["benchmark decontamination"](spark, docs, sf_dir).collect()} == {i for i, _ in plain} - leaks
    out = corpus_pipeline.run(spark, sf_dir)
    assert set(docs.columns) | {"pass", "first_slot", "taken"} == set(out.columns)
    assert out.count() > 0
