"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import alignment, collocations, contamination, embeddings, lattice, licenses, line_dedup, minhash, mixing, token_counts, toxicity, urls, warc
from flowlake.llm.scratch import Scratch

#: Host, path and verdict of the registered query's rules.
URL_RULES = [
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
]
#: The phrases whose places are counted, with their labels.
LICENSE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Statements of common licenses. Short ones must be whole, of long ones four fifths of the words.
LICENSE_TEMPLATES = [
    licenses.Template("all-rights-reserved", "All rights reserved"),
    licenses.Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    licenses.Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at",
        "0.8",
    ),
    licenses.Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "0.8",
    ),
    licenses.Template("cc-by-nc", "Licensed under CC BY-NC"),
    licenses.Template("cc-by-nc", "Creative Commons Attribution NonCommercial"),
    licenses.Template("cc-by-sa", "Licensed under CC BY-SA"),
    licenses.Template("cc-by-sa", "Creative Commons Attribution ShareAlike"),
    licenses.Template(
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "0.8",
    ),
    licenses.Template("gpl-3.0", "Licensed under the GNU General Public License, version 3"),
    licenses.Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
        "0.8",
    ),
    licenses.Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
        "0.8",
    ),
    licenses.Template("lgpl", "GNU Lesser General Public License"),
    licenses.Template("mit", "Released under the MIT License"),
    licenses.Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "0.8",
    ),
    licenses.Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "0.8"),
    licenses.Template("unlicense", "This is free and unencumbered software released into the public domain", "0.8"),
]
TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4_096
TOXIC_FROM = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(divisor: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def _tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4, similarity=0.8)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.Contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.pairs()


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"), similarity=0.9)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "archive").path("warc")
    files = warc.write_warc(_table(spark, sf_dir, "pages"), folder, least_bytes=0)
    records = warc.read_warc(files, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", _remainder(10) == 0)
    out = lattice.lattice_scores(docs, ~F.col("held_out"), _tokenizer())
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "ratio")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, _tokenizer())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.Mix(docs).documents().select("doc_id", "source", "size", "source_size", "target", "taken")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Toxicity:
    """Fitted on the labelled documents outside the held-out fold."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    labelled = toxicity.labelled_texts(_table(spark, sf_dir, "documents"), labels, _remainder(3) != 1)
    return toxicity.Toxicity(labelled)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_model(spark, sf_dir).scored(docs)
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_table(spark, sf_dir, "documents"), least_words=1)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return collocations.Collocations(docs, most_words=5, least=100, cover=100).top(2_000)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.Alignment(docs, str(public_tokenizers.path("byte_bpe_50k.json")), _tokenizer()).documents()


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.LicenseScan(docs, LICENSE_PHRASES, LICENSE_TEMPLATES).documents()


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_benchmark_decontamination, op3_embedding_near_dedup, op4_warc, op5_lattice_scores,
        op6_url_filter, op7_token_counts, op8_source_mix, op9_toxicity, op10_line_dedup, op11_phrase_collocations,
        op12_tokenizer_alignment, op13_license_scan,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
spoken AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM spoken),
grams AS (SELECT lang, w[i:i + size - 1] AS g FROM starts, range(1, 6) AS s(size) WHERE i + size - 1 <= len(w)),
f AS (SELECT lang, g, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 100 OR len(g) = 1),
totals AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
candidates AS (SELECT lang, g, c AS a FROM f WHERE len(g) > 1 AND c >= 100),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.g, c.a, c.k, x.c AS l, y.c AS r, t.n,
         ((1000::HUGEINT * c.a * t.n) // (x.c::HUGEINT * y.c))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.k]
  JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1:len(c.g)] JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT c.lang, c.g[i:i + size - 1] AS g, c.a FROM candidates c, range(1, 6) AS s(i), range(2, 5) AS z(size)
  WHERE size < len(c.g) AND i + size - 1 <= len(c.g)),
alone AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = b.lang AND x.g = b.g AND 100 * x.a >= 100 * b.a)),
named AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM alone),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM named)
SELECT * FROM ranked WHERE rank <= 2000
"""



def _op13() -> str:
    def listed(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    phrases = ", ".join(f"('{label}', {listed(licenses.words(p))})" for p, label in LICENSE_PHRASES.items())
    made = enumerate(licenses.entries(LICENSE_TEMPLATES))
    templates = ", ".join(f"({i}, '{e.label}', {listed(e.words)}, {e.needed}, {e.reach})" for i, e in made)
    return f"""
WITH phrases(label, p) AS (VALUES {phrases}),
templates(no, label, t, needed, reach) AS (VALUES {templates}),
texts AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
places AS (SELECT id, w, unnest(range(len(w))) AS i FROM texts),
base AS (SELECT id, label, i FROM places, phrases WHERE w[i + 1:i + len(p)] = p),
based AS (
  SELECT id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
  FROM base GROUP BY id),
needed AS (SELECT no, label, len(t) AS size, needed, reach, unnest(t) AS word FROM templates),
met AS (SELECT id, no, label, size, needed, word, unnest([i // reach, i // reach - 1]) AS block FROM places JOIN needed ON w[i + 1] = word),
blocks AS (
  SELECT id, no, label, block, count(DISTINCT word) / size AS share
  FROM met WHERE block >= 0 GROUP BY id, no, label, size, needed, block HAVING count(DISTINCT word) >= needed),
found AS (SELECT id, max(share) AS share, list(DISTINCT label) AS labels FROM blocks GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM texts t LEFT JOIN based b USING (id) LEFT JOIN found f USING (id)
"""


def _shingled(table: str, key: str, width: int) -> str:
    """Rows of ``key`` and ``g``, the distinct shingles of a text; with fewer words all words are one."""
    return f"""
  SELECT {key}, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [w]
    ELSE list_transform(range(1, len(w) - {width - 2}), lambda i: w[i:i + {width - 1}]) END) AS g
  FROM (SELECT {key}, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table})"""


#: Follows rows ``links(x, y)``: the smallest id reachable from each row of ``nodes(id)``.
_COMPONENTS = """
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT id AS node, id AS root FROM nodes UNION SELECT b.y, r.root FROM reach r JOIN both_ways b ON b.x = r.node),
component AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)"""

_OP1 = f"""
WITH RECURSIVE sets AS ({_shingled("documents", "doc_id", 4)}),
elements AS (SELECT doc_id, len(g) AS n, unnest(g) AS e FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
nodes AS (SELECT doc_id AS id FROM documents),{_COMPONENTS}
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN component ON node = doc_id
"""

_OP2 = f"""
WITH docs AS ({_shingled("documents", "doc_id", 5)}),
items AS ({_shingled("benchmark", "item_id", 5)}),
held AS (SELECT doc_id, unnest(g) AS e FROM docs),
wanted AS (SELECT item_id, len(g) AS n, unnest(g) AS e FROM items)
SELECT doc_id, item_id, n::BIGINT AS n_item, count(*) AS n_found
FROM held JOIN wanted USING (e) GROUP BY doc_id, item_id, n HAVING 5 * count(*) >= 4 * n
"""

_OP3 = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
sound AS (
  SELECT vec_id, v, list_dot_product(v, v) AS vv FROM vectors
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(a.vv * b.vv) >= 0.9),
nodes AS (SELECT vec_id AS id FROM embeddings),{_COMPONENTS},
degree AS (SELECT x, count(*) AS n FROM both_ways GROUP BY x)
SELECT node AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, node = component_id AS kept
FROM component LEFT JOIN degree ON x = node
"""

# Five hexadecimal digits are four base-32 digits.
_BASE32 = "array_to_string([" + ", ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(hex, {5 * k + 1}, 5))::BIGINT >> {15 - 5 * d} & 31)::INT + 1, 1)"
    for k in range(8) for d in range(4)
) + "], '')"

_OP4 = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT p, min(page_id) AS first_id FROM payloads GROUP BY p)
SELECT page_id, strlen(p)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads JOIN firsts USING (p)
"""

ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": _OP1, "op2_benchmark_decontamination": _OP2, "op3_embedding_near_dedup": _OP3, "op4_warc": _OP4,
    "op13_license_scan": _op13(), "op11_phrase_collocations": _OP11}
