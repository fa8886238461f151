"""The registered queries over the smallest tables."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    2: "doc_id held_out lang_pred score",
    3: "doc_id fingerprint component_id",
    4: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    5: "doc_id n_words n_tokens",
    6: "doc_id n_tokens ids_sha256 decoded_sha256",
    7: "doc_id n_words n_removed kept_sha256",
    8: "doc_id held_out n_tokens n_known train_tokens base_score score",
    9: "query_id rank vec_id score",
    10: "doc_id n_assign n_access n_hex base_sha256 spans",
    11: "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    12: "item_id rank doc_id score",
    13: "doc_id n_lines n_dropped kept_sha256",
}


def test_each_operator_has_one_query():
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_query(spark, n):
    name = next(k for k in entry.queries() if k.startswith(f"op{n}_"))
    df = entry.queries()[name](spark, SF)
    assert set(COLUMNS[n].split()) <= set(df.columns)
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = df.collect()
    if n == 9:
        vectors = [r.vec_id for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id").collect()]
        assert len(rows) == 20 * sum(v % 20 == 0 for v in vectors)
    elif n == 11:
        assert len(rows) == spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    elif n == 12:
        assert len(rows) == len({(r.item_id, r["rank"]) for r in rows}) and max(r["rank"] for r in rows) == 20
    elif n == 4:
        assert len({r.doc_id for r in rows}) == docs
    else:
        assert len(rows) == docs
