import duckdb
import pytest

import __spark_entry__ as registered
from check import differences
from quillstat.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "conversations", "events", "embeddings", "benchmark", "pages")
# One query per family; check.py compares all of them.
NAMES = ("clean_url_injected", "dup_sentences", "admission_codes", "features_sentence", "split_exact",
         "tfidf_weights", "two_level_scores", "robustness_by_attack", "box_stats", "dbscan",
         "admission_batch", "corpus_document_table", "job_density_clusters", "eps_sweep", "correlation",
         "monitor_live", "predictions", "typed_training_scan", "dedup_audit")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    base = duckdb.connect()
    for table in TABLES:
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = registered.queries()[name](spark, FOLDER).toPandas()
    assert differences(got, base.sql(registered.oracle_sql()[name]).df()) is None


def test_registration():
    queries, oracle = registered.queries(), registered.oracle_sql()
    assert set(oracle) <= set(queries) and set(QUERIES) <= set(queries)
    assert set(QUERIES) - set(oracle) == {
        "kmeans_fit", "kmeans_sweep", "train_logistic", "train_svm_calibrated", "train_trees"}
