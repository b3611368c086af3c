import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from quillstat.operators.scoring import StyleModel
from quillstat.plans import training
from quillstat.sources import readers, sinks
from quillstat.streaming.scoring import score_stream

SUBJECTS = ("gulls", "tides", "harbours", "lanterns", "ferries")


def sentence(kind: str, number: int) -> str:
    """Short and plain for one class, long and heavy for the other."""
    subject = SUBJECTS[number % len(SUBJECTS)]
    if kind == "human":
        return f"saw {subject} no {number} off the pier, wet feet again"
    return f"Subsequently, {subject} designation {number} demonstrates considerable operational significance"


@pytest.fixture
def dataset(spark, tmp_path):
    rows = [(f"{kind[0]}-{i}", 0, sentence(kind.lower(), i), kind) for i in range(20) for kind in ("human", "AI")]
    rows = [(r[0].lower(), *r[1:]) for r in rows]
    frame = spark.createDataFrame(rows, "doc_id string, sent_id int, text string, label string")
    path = str(tmp_path / "data.csv")
    frame.toPandas().to_csv(path, index=False)
    return path


def test_train_save_load_and_predict(spark, tmp_path, dataset):
    config = training.TrainingConfig(
        dataset, str(tmp_path / "out" / "sentence"), str(tmp_path / "art"), max_features=500, trees=4)
    result = training.run_training(spark, config)
    f1 = {r.model: r.f1 for r in result["validation_metrics"].collect()}
    assert f1[result["metadata"]["selected_model_display"]] == max(f1.values())
    metrics = result["test_metrics"].collect()
    assert {r.model for r in metrics} == {"Logistic Regression", "Linear SVM", "XGBoost"}
    assert all(0 <= r.f1 <= 1 for r in metrics)
    assert result["audit"]["final_documents"] == 40
    metadata = sinks.read_metadata(spark, str(tmp_path / "art" / "model_metadata"))
    assert metadata["split_documents"] == {"train": 28, "validation": 6, "test": 6}
    assert json.dumps(metadata)
    level = spark.read.parquet(str(tmp_path / "out" / "level_comparison"))
    assert {r.unit for r in level.collect()} == {"sentence"}
    trace = spark.read.parquet(str(tmp_path / "out" / "sentence" / "test_predictions"))
    assert trace.count() == 18 and {"true_label", "score_type", "split"} <= set(trace.columns)

    scorer = training.load_scorer(str(tmp_path / "art"))
    texts = spark.createDataFrame(
        [(k + 1, f"{sentence(kind, 40)}. {sentence(kind, 41)}.") for k, kind in enumerate(("human", "ai"))]
        + [(3, None), (4, " "), (5, "?! ...")], "doc_id int, text string")
    for unit in ("sentence", "document"):
        got = {r.doc_id: r for r in training.predict(scorer, texts, unit=unit).collect()}
        assert {r.label for r in got.values()} <= {"human", "ai"}
        assert all(0 <= r.score <= 1 for r in got.values())
        assert got[1].sentences == (2 if unit == "sentence" else 1)
        verdicts, sentences, rejected = training.predictions(scorer, texts, unit=unit)
        assert {r.doc_id for r in verdicts.collect()} == {1, 2} and {r.score_type for r in verdicts.collect()} == {"ai_probability"}
        assert {r.doc_id: r.reject_code for r in rejected.collect()} == {3: "EMPTY_TEXT", 4: "EMPTY_TEXT", 5: "NO_WORDS"}
        assert sentences.count() == (4 if unit == "sentence" else 0)
        first = verdicts.first()
        assert first.lower is None if unit == "document" else first.lower <= first.score <= first.upper
    placed = texts.where("doc_id = 1").withColumns({"at": F.lit(1), "of": F.lit(2)})
    direct = scorer(placed, "text", "score", position=F.col("at"), total=F.col("of")).first().score
    assert 0 <= direct <= 1
    sentences = {r.doc_id: r.label for r in training.predict(scorer, texts).collect()}
    assert sentences == {1: "human", 2: "ai"}
    with pytest.raises(ValueError, match="unit"):
        training.predict(scorer, texts, unit="page")


def test_loader_checks(spark, tmp_path, dataset):
    with pytest.raises(FileNotFoundError):
        readers.training_dataset(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match="lacks"):
        readers.training_dataset(spark, dataset, text_column="body")
    raw = readers.training_dataset(spark, dataset)
    with pytest.raises(ValueError, match="labels"):
        training.prepare_dataset(raw.withColumn("label", F.lit("robot")))
    few = raw.where("doc_id like 'h-%' or doc_id in ('a-1', 'a-2')")
    with pytest.raises(ValueError, match="fewer documents"):
        training.prepare_dataset(few)


def test_archives_samples_and_sinks(spark, tmp_path, dataset):
    archive = str(tmp_path / "data.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        packed.write(dataset, "x/clean_dataset.csv")
        packed.writestr("x/other.csv", "a\n1\n")
    assert readers.training_dataset(spark, archive, zip_member="x/clean_dataset.csv").count() == 40
    with pytest.raises(Exception, match="name one member"):
        readers.training_dataset(spark, archive).count()
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"note": "x", "ai_samples": ["p", "q"], "clean_controls": ["r"]}))
    rows = {tuple(r) for r in readers.sample_sets(spark, str(path)).collect()}
    assert rows == {("ai_samples", 1, "p"), ("ai_samples", 2, "q"), ("clean_controls", 1, "r")}
    table = str(tmp_path / "level")
    first = spark.createDataFrame([("m", "a", 1)], "model string, unit string, v int")
    sinks.upsert_partitions(first, table, key="unit")
    sinks.upsert_partitions(first.withColumn("unit", F.lit("b")), table, key="unit")
    sinks.upsert_partitions(first.withColumn("v", F.lit(9)), table, key="unit")
    assert {(r.unit, r.v) for r in spark.read.parquet(table).collect()} == {("a", 9), ("b", 1)}
    sinks.write_table(first, str(tmp_path / "csv"), fmt="csv")
    assert readers.read_table(spark, str(tmp_path / "csv"), fmt="csv").first().asDict() == {"model": "m", "unit": "a", "v": "1"}
    sinks.write_experiment(first, first, str(tmp_path / "exp"))
    assert os.path.isdir(tmp_path / "exp" / "summary")


def test_stream_quarantines_and_scores(spark, tmp_path):
    texts = spark.createDataFrame([(1, "One fine sentence here. Another one follows it."), (2, "bad")],
                                  "doc_id long, text string")
    texts.write.parquet(str(tmp_path / "in"))
    model = StyleModel({"avg_word_len": 0.5}, -1.0)
    stream = spark.readStream.schema(texts.schema).parquet(str(tmp_path / "in"))
    score_stream(stream, sentence_scorer=model, document_scorer=model,
                 accepted_path=str(tmp_path / "ok"), rejected_path=str(tmp_path / "no"),
                 checkpoint=str(tmp_path / "state")).awaitTermination()
    good = spark.read.parquet(str(tmp_path / "ok")).first()
    assert len(good.sentence_results) == 2 and good.confidence_range.lower <= good.confidence_range.upper
    assert spark.read.parquet(str(tmp_path / "no")).first().reject_code == "TEXT_TOO_SHORT"


def test_ids_that_are_numbers_sort_as_numbers(spark, tmp_path):
    rows = [(i, k, f"own text {i} {k} of this document", "human" if i < 20 else "ai") for i in (*range(1, 17), *range(20, 32)) for k in range(2)]
    rows += [(i, 2, "the same words stand in both", "human") for i in (9, 11)]
    path = str(tmp_path / "numbers.csv")
    spark.createDataFrame(rows, "doc_id int, sent_id int, text string, label string").toPandas().to_csv(path, index=False)
    data, audit = training.prepare_dataset(readers.training_dataset(spark, path))
    assert [r.doc_id for r in data.where("text like 'the same%'").collect()] == [9]
    assert audit["duplicate_sentence_rows_removed"] == 1
    from quillstat.operators import corpus
    kept = corpus.numeric_ids(spark.createDataFrame([("007", "1"), ("8", None)], "a string, b string"), ("a", "b", "c"))
    assert dict(kept.dtypes) == {"a": "string", "b": "bigint"}


def test_keys_on_computed_tables(spark):
    from quillstat.operators import corpus
    made = spark.range(3).select(F.concat(F.lit("t"), "id").alias("text")).unionAll(spark.range(2).select(F.lit("u").alias("text")))
    assert sorted(r.doc_id for r in corpus.with_keys(made).collect()) == list(range(5))


def test_calibration_folds_share_classes_evenly_and_keep_documents_whole(spark):
    from quillstat.operators.models import FOLDS, _with_folds

    rows = [(d, s, 1 if d % 4 == 0 else 0) for d in range(48) for s in range(1 + d % 3)]
    got = _with_folds(spark.createDataFrame(rows, "doc_id long, sent_id int, label int"), 42).collect()
    assert sorted((r.doc_id, r.sent_id, r.label) for r in got) == sorted(rows)
    places = {(r.doc_id, r.label, r._fold) for r in got}
    assert len(places) == 48
    for label, share in ((0, 36 // FOLDS), (1, 12 // FOLDS)):
        assert [sum(p[1:] == (label, f) for p in places) for f in range(FOLDS)] == [share] * FOLDS
