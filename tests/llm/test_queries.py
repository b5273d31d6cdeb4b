"""The registered queries: against their SQL where they have one, and the shape of all results."""

import os

import duckdb
import pytest

from lakemart.llm import queries

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    1: "doc_id n_words n_removed kept_sha256",
    2: "doc_id n_bytes n_removed n_spans kept_sha256",
    3: "doc_id text_score meta_score score keep",
    4: "doc_id held_out n_tokens n_known train_tokens base_score score",
    5: "doc_id start length doc_tokens ids_crc32 sequence_id offset",
    6: "page_id payload_bytes payload_digest record_type refers_to",
    7: "doc_id n_words n_hit n_items items_sha256 contaminated",
    8: "doc_id n_assign n_access n_hex base_sha256 spans",
    9: "query_id rank vec_id score",
    10: "doc_id fingerprint component_id",
    11: "doc_id n_shingles component_id n_links",
    12: "word form root n n_near form_n",
    13: "doc_id leaf subroot root proof_sha256 folded_root verified",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def test_one_query_per_operator_and_the_pipeline():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES if name != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, oracle, rows, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    if name != "pipeline":
        assert df.columns == COLUMNS[int(name[2:].split("_")[0])].split()
    if name in queries.ORACLES:
        result = oracle.execute(queries.ORACLES[name])
        names = [column[0] for column in result.description]
        assert sorted(df.columns) == sorted(names)
        assert rows(df, *names) == sorted((tuple(row) for row in result.fetchall()), key=repr)
    else:
        assert df.count() > 0
