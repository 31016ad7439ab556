"""The registered text queries: SQL twins, and names and rules of their columns."""

import zlib

import pytest
from compare import connect, differences

from flowlake.llm import catalog

COLUMNS = {
    "op5_lattice_scores": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op7_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op8_source_mix": ["doc_id", "source", "size", "source_size", "target", "taken"],
    "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op10_line_dedup": ["doc_id", "n_lines", "n_removed", "removed_lines"],
    "op12_tokenizer_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
}


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), name, catalog.QUERIES[name], catalog.ORACLES[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rules(spark, sf_dir, name):
    rows = catalog.QUERIES[name](spark, sf_dir)
    assert rows.columns == COLUMNS[name]
    rows = rows.collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        crc = zlib.crc32(str(r.doc_id).encode())
        if name == "op5_lattice_scores":
            assert r.held_out == (crc % 10 == 0) and r.score < 0
        elif name == "op9_toxicity":
            assert r.held_out == (crc % 3 == 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1
        elif name == "op7_token_counts":
            assert r.over_limit == (r.n_tokens > 4_096)
        elif name == "op8_source_mix":
            assert 0 <= r.taken <= 2 * r.size
        elif name == "op10_line_dedup":
            assert r.n_removed == len(r.removed_lines) <= r.n_lines and list(r.removed_lines) == sorted(r.removed_lines)
