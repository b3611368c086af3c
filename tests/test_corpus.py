import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstat.operators import corpus, quality, running, split
from quillstat.plans import corpus_build
from quillstat.sources import readers


def test_labels(spark):
    raw = [" Human ", "AI", "1.0", "0", "ai-generated", "human_written", "robot", None]
    frame = spark.createDataFrame([(r,) for r in raw], "label string")
    assert [r[0] for r in frame.select(corpus.loader_label(F.col("label"))).collect()] == [0, 1, 1, 0, 1, 0, None, None]
    mapped = corpus.map_corpus_labels(frame)
    assert [r[0] for r in mapped.collect()] == [0, 1, None, None, None, None, None, None]
    numbers = spark.createDataFrame([(1.0,), (0.0,)], "label double")
    assert [r[0] for r in corpus.map_corpus_labels(numbers).collect()] == [1, 0]
    assert spark.range(2).select(corpus.label_name(F.col("id"))).collect()[1][0] == "ai"


def test_column_aliases(spark):
    frame = spark.createDataFrame([("s", "t", 1)], ["Source", " Essay ", "label"])
    assert readers.resolve_columns(frame).collect()[0].asDict() == {"text": "t", "label": 1}
    with pytest.raises(ValueError, match="lacks a column"):
        readers.resolve_columns(frame.select("Source"))


def test_merge_keeps_the_first_copy_in_input_order(spark):
    schema = "text string, label int, source string, prompt string, k long"
    good = "This is a long enough text number {}."
    a = spark.createDataFrame([(good.format(1), 0, "a", None, 5), (good.format(1), 1, "a", "p", 3),
                               ("short", 1, "a", None, 1)], schema)
    b = spark.createDataFrame([(good.format(1), 1, "b", None, 0), (good.format(2), 1, "b", None, 1)], schema)
    merged = corpus_build.merge_sources([corpus_build.prepare_source(x, order="k") for x in (a, b)])
    numbered = corpus_build.number_documents(merged).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text[-2], r.label, r.source) for r in numbered] == [(0, "1", 1, "a"), (1, "2", 1, "b")]
    docs = corpus_build.document_corpus(spark.createDataFrame(numbered)).collect()
    assert {d.sent_id for d in docs} == {0} and {d.doc_pos for d in docs} == {0.0}


def test_duplicate_documents_ignore_where_sentences_were_cut(spark):
    rows = [(1, 0, "a b"), (1, 1, "c"), (2, 0, "a"), (2, 5, "b c"), (3, 0, "a b c d"), (4, 0, "a  b c"),
            (5, 0, "c"), (5, 1, "a b"), (6, 9000, "d"), (6, 3, "a b c")]
    frame = spark.createDataFrame(rows, "doc_id int, sent_id int, text string")
    prints = corpus.document_fingerprints(frame, span=4)
    assert {r.doc_id for r in corpus.duplicate_documents(prints).collect()} == {2, 6}


def test_overlap_rules_and_audit(spark):
    rows = [(1, 0, "same", 0), (2, 0, "same", 0), (1, 1, "clash", 0), (3, 0, "clash", 1), (3, 1, "own", 1),
            (4, 0, "same", 0)]
    frame = spark.createDataFrame(rows, "doc_id int, sent_id int, text string, label int")
    kept = {(r.doc_id, r.sent_id) for r in corpus.drop_sentence_overlap(frame).collect()}
    assert kept == {(1, 0), (3, 1)}
    assert corpus.drop_conflicting_texts(frame).count() == 4
    audit = corpus.dedup_audit(frame).first().asDict()
    # Document 4 repeats document 2; then two clashing rows and one repeated row go.
    assert audit == {"original_rows": 6, "original_documents": 4, "duplicate_documents_removed": 1,
                     "conflicting_sentence_rows_removed": 2, "duplicate_sentence_rows_removed": 1,
                     "final_rows": 2, "final_documents": 2}


def test_constraints_report_each_violation(spark):
    rows = [(1, 0, "x", 0, "s", "1"), (1, 0, "y", 1, "s", "z"), (2, 0, " ", 1, "a", "inf"), (2, 1, "w", None, "b", "2")]
    frame = spark.createDataFrame(rows, "doc_id int, sent_id int, text string, label int, source string, f string")
    report = quality.quality_report(frame, features=("f",))
    got = {r.constraint: r.violations for r in report.collect()}
    assert got == {"empty_text": 1, "unsupported_label": 1, "bad_feature": 1, "infinite_feature": 1,
                   "duplicate_key": 1, "duplicate_sample_id": 1, "mixed_label": 1, "mixed_source": 1,
                   "thin_class": 2}
    with pytest.raises(ValueError, match="null or blank"):
        quality.enforce(report)
    with pytest.raises(ValueError, match="lacks body"):
        quality.require_columns(frame, {"body"})


def test_keys(spark, tmp_path):
    spark.createDataFrame([(f"t{i}", i) for i in range(9)], "text string, n int").coalesce(1).write.csv(
        str(tmp_path / "c"), header=True)
    numbered = corpus.with_keys(readers.read_table(spark, str(tmp_path / "c"), fmt="csv"), id_column="id")
    assert [(r.text, r.doc_id, r.sent_id) for r in numbered.orderBy("doc_id").collect()] == [
        (f"t{i}", i, 0) for i in range(9)]
    keyed = corpus.with_defaults(corpus.with_keys(spark.createDataFrame([(7, None)], "id int, source string")))
    row = corpus.with_sample_id(keyed).first()
    assert (row.doc_id, row.source, row.prompt, row.sample_id) == (7, "unknown", "unknown", "7:0")


def test_running_totals_ranks_and_quantiles(spark):
    rng = random.Random(2)
    rows = [(k, i, rng.randrange(9)) for k in "ab" for i in rng.sample(range(10_000), 200)]
    frame = spark.createDataFrame(rows, "k string, i long, v long")
    total = running.running_total(
        frame, keys=["k"], bucket=F.floor(F.col("i") / 500), order=["i"], value=F.col("v"), out="s")
    got = {(r.k, r.i): r.s for r in total.collect()}
    for k in "ab":
        mine = sorted((i, v) for kk, i, v in rows if kk == k)
        for (i, _), s in zip(mine, np.cumsum([v for _, v in mine])):
            assert got[k, i] == s
    values = [(k, rng.choice([0.5, rng.random() * 100])) for k in "abc" for _ in range(101)] + [("one", 3.0)]
    quantiles = running.exact_quantiles(
        spark.createDataFrame(values, "k string, v double"), by=["k"], value="v",
        probabilities={"q1": 0.25, "p99": 0.99, "least": 0.0, "most": 1.0}, buckets=7).collect()
    for row in quantiles:
        mine = [v for k, v in values if k == row.k]
        assert [row.q1, row.p99, row.least, row.most] == pytest.approx(list(np.quantile(mine, [0.25, 0.99, 0, 1])))


def test_dense_index_has_no_gaps(spark):
    frame = spark.range(0, 3000, 3).select((F.col("id") * 7 % 3001).alias("k")).repartition(5)
    rows = running.dense_index(frame, order=["k"], out="n", partitions=6).orderBy("k").collect()
    assert [r.n for r in rows] == list(range(1000))


def test_splits(spark):
    frame = spark.range(1000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 10 < 3).cast("int").alias("label"))
    doubled = frame.union(frame)
    exact = split.exact_split(doubled, seed=7)
    counts = {(r.split, r.label): r["count"] for r in exact.groupBy("split", "label").count().collect()}
    assert counts == {("test", 0): 210, ("test", 1): 90, ("validation", 0): 210, ("validation", 1): 90,
                      ("train", 0): 980, ("train", 1): 420}
    assert split.split_leaks(exact).isEmpty()
    again = split.exact_split(doubled, seed=7)
    assert exact.exceptAll(again).isEmpty()
    quick = split.split_documents(doubled, seed=7)
    shares = {r.split: r.documents for r in split.split_summary(quick).collect()}
    assert sum(shares.values()) == 1000 and 100 < shares["test"] < 200
    with pytest.raises(ValueError):
        split.split_documents(frame, test_size=0.6, validation_size=0.5)


def test_samples(spark):
    frame = spark.range(500).withColumn("g", F.col("id") % 3)
    first = {r.id for r in split.sample_rows(frame, n=40, keys=["id"]).collect()}
    assert len(first) == 40
    assert first == {r.id for r in split.sample_rows(frame.repartition(7), n=40, keys=["id"]).collect()}
    assert split.sample_rows(frame, n=10_000, keys=["id"]).count() == 500
    assert split.examples_per_group(frame, group="g", keys=["id"], n=4).groupBy("g").count().where("count = 4").count() == 3
