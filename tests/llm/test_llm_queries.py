"""Registered queries of this folder on the test tables: equal to their comparison SQL, or of the right shape."""

import pytest

from compare import _rows, connect
from pitwall.llm.queries import QUERIES, SQL

DIGESTS = {
    "op1_": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_": ["doc_id", "fingerprint", "component_id"],
    "op5_": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op6_": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op7_": ["doc_id", "size", "source_size", "target", "taken"],
    "op9_": ["doc_id", "held_out", "score", "predicted"],
    "op10_": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op12_": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op11_": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    df = QUERIES[name](spark, data)
    rows = [tuple(r) for r in df.collect()]
    for prefix, columns in DIGESTS.items():
        if name.startswith(prefix):
            assert df.columns[: len(columns)] == columns
            assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()
    if name in SQL:
        cur = connect(data).execute(SQL[name])
        names = [c[0] for c in cur.description]
        assert not any("HUGEINT" in str(c[1]) for c in cur.description)
        assert sorted(names) == sorted(df.columns)
        assert _rows(df.columns, rows) == _rows(names, cur.fetchall())
