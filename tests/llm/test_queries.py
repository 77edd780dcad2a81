"""The registered queries: columns of their contracts, SQL twins, and native plans."""

import pytest

from postloom.llm.queries import QUERIES, SQL
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_licences": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op3_token_shards": "slot bigint, shard int, doc_id bigint, seq int, n_tokens int, tokens_crc32 bigint",
    "op4_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op5_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op7_decontamination": "doc_id bigint, item_id bigint, n_tokens bigint, n_aligned bigint, longest_run bigint, cover double, n_slots bigint, n_consistent bigint, kind string",
    "op8_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op9_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op10_mixing": "doc_id bigint, n_tokens bigint, p_good double, p_poor double, p_toxic double, rate double, copies int",
    "op11_importance": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op12_exact": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op13_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_all_are_registered():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == list(COLUMNS) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_sql(spark, connection, plan, name):
    df = QUERIES[name](spark, SF_DIR)
    types = dict(df.dtypes)
    for column in COLUMNS[name].split(", "):
        own, kind = column.split()
        assert types[own] == kind
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "BatchEvalPython" not in text
    if name in ("op1_sharding", "op6_warc", "op10_mixing", "op12_exact", "op13_collocations"):
        assert "EvalPython" not in text and "MapInArrow" not in text
    if name in SQL:
        assert compare(df, connection, SQL[name]) == ""
    elif name not in ("op7_decontamination", "op3_token_shards"):
        assert df.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
