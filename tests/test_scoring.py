import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstat.operators import evaluate, models, robustness, scaling, scoring, tfidf
from quillstat.operators.scoring import StyleModel

MODEL = StyleModel({"avg_word_len": 1.0, "upper_letter_ratio": 2.0}, -4.0)


def test_margin_of_zero_is_half(spark):
    """Mean word length 7, all words long, 3.875 bits a character: -4.2 + 2 + 3.1 - 0.9 = 0."""
    model = StyleModel({"avg_word_len": -0.6, "complex_word_ratio": 2.0, "char_entropy": 0.8}, -0.9)
    frame = spark.createDataFrame([("Chêtion ierçaux.",), ("Ungpfte lichber.",)], "text string")
    assert [r.p for r in model(frame, "text", "p").collect()] == [0.5, 0.5]


def test_bootstrap_edges_and_spread(spark):
    rng = np.random.default_rng(0)
    rows = [("one", 0, 0.4), ("nan", 0, 0.4), ("nan", 1, float("nan")), ("flat", 0, 0.3), ("flat", 1, 0.3)]
    values = rng.random(200)
    rows += [("many", i, float(v)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "doc_id string, sent_id int, score double")
    got = {r.doc_id: (r.lower, r.upper) for r in evaluate.bootstrap_interval(frame).collect()}
    assert got["one"] == got["nan"] == (None, None)
    assert got["flat"] == pytest.approx((0.3, 0.3))
    width = 1.96 * values.std() / np.sqrt(len(values))
    assert got["many"] == pytest.approx((values.mean() - width, values.mean() + width), abs=0.2 * width)
    again = {r.doc_id: (r.lower, r.upper) for r in evaluate.bootstrap_interval(frame.repartition(3)).collect()}
    assert again == got


def test_chunked_bootstrap_agrees_with_whole_rows(spark, monkeypatch):
    monkeypatch.setattr(evaluate, "CHUNK", 100)
    values = np.random.default_rng(1).random(1500)
    rows = [("d", i, float(v)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "doc_id string, sent_id int, score double")
    row = evaluate.bootstrap_interval(frame).first()
    width = 1.96 * values.std() / np.sqrt(len(values))
    assert row.lower == pytest.approx(values.mean() - width, abs=0.2 * width)
    assert row.upper == pytest.approx(values.mean() + width, abs=0.2 * width)


def test_bands_percent_and_confidence(spark):
    rows = [("ai", 0.9), ("ai", 0.7), ("ai", 0.5), ("ai", 0.49), ("human", 0.95)]
    frame = spark.createDataFrame(rows, "label string, p double")
    got = frame.select(scoring.likelihood_band(F.col("label"), F.col("p")).alias("b"),
                       scoring.whole_percent(F.col("p")).alias("w"),
                       scoring.confidence(F.col("p")).alias("c")).collect()
    assert [r.b for r in got] == ["strong", "moderate", "low", "low", "human"]
    assert [r.w for r in got] == [90, 70, 50, 49, 95]
    assert got[3].c == pytest.approx(0.51)


def test_metrics_selection_and_upsert(spark):
    rows = [("m", "s", 1, 0), ("m", "s", 0, 0)]
    frame = spark.createDataFrame(rows, "model string, split string, label int, prediction int")
    row = evaluate.binary_metrics(frame).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.5, 0.0, 0.0, 0.0)
    metrics = spark.createDataFrame(
        [("XGBoost", 0.5785, 0.7735), ("Linear SVM", 0.7461, 0.8), ("Logistic Regression", 0.7461, 0.8)],
        "model string, f1 double, accuracy double")
    assert evaluate.select_model(metrics).first().model == "Logistic Regression"
    old = spark.createDataFrame([("sentence", 1), ("document", 2)], "unit string, v int")
    new = spark.createDataFrame([("sentence", 9)], "unit string, v int")
    assert {tuple(r) for r in evaluate.upsert(old, new, key="unit").collect()} == {("sentence", 9), ("document", 2)}


def test_class_weights_imputing_and_scaling(spark):
    frame = spark.createDataFrame([(1, 1.0, 2.0), (0, None, 2.0), (0, 3.0, 2.0), (0, 8.0, 2.0)],
                                  "label int, a double, b double")
    weights = {r.label: r.weight for r in models.class_weights(frame).collect()}
    assert weights == pytest.approx({1: 2.0, 0: 4 / 6})
    filled = scaling.impute_median(frame, ["a", "b"])
    assert sorted(r.a for r in filled.collect()) == [1.0, 3.0, 3.0, 8.0]
    scaled = scaling.standardise(filled, ["a", "b"]).collect()
    values = np.array([r.a for r in scaled])
    assert values.mean() == pytest.approx(0) and values.std() == pytest.approx(1)
    assert {r.b for r in scaled} == {0.0}


def test_tfidf_against_a_plain_calculator(spark):
    texts = ["the cat the cat sat", "the dog sat", "a bird the cat", "dog dog dog x"]
    frame = spark.createDataFrame(list(enumerate(texts)), "sample_id long, text string")
    vocab, weights = tfidf.tfidf(frame, max_features=5)
    counts, documents = {}, {}
    per_text = []
    for text in texts:
        tokens = [w for w in text.split() if len(w) > 1]
        grams = tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]
        tf = {g: grams.count(g) for g in grams}
        per_text.append(tf)
        for g, n in tf.items():
            counts[g] = counts.get(g, 0) + n
            documents[g] = documents.get(g, 0) + 1
    allowed = sorted((g for g in counts if 2 <= documents[g] <= 0.98 * 4), key=lambda g: (-counts[g], g))[:5]
    assert [r.term for r in vocab.orderBy(F.desc("total"), "term").collect()] == allowed
    idf = {g: np.log(5 / (1 + documents[g])) + 1 for g in allowed}
    got = {(r.sample_id, r.term): r.weight for r in weights.collect()}
    want = {}
    for i, tf in enumerate(per_text):
        row = {g: (1 + np.log(n)) * idf[g] for g, n in tf.items() if g in idf}
        length = np.sqrt(sum(v * v for v in row.values()))
        want.update({(i, g): v / length for g, v in row.items()})
    assert got == pytest.approx(want)


def test_variants_and_summary(spark):
    text = "Furthermore the apex of excellence"
    frame = spark.createDataFrame([(1, text), (2, "No caps at it")], "sample int, text string")
    attacks = {r.attack: r.attacked for r in robustness.perturb(frame.where("sample = 1")).collect()}
    words = ["Furth​ermore", "the", "apex", "of", "excel​lence"]
    swap = str.maketrans("aeopcxi", "аеорсхі")
    assert attacks == {
        "confusables": text.translate(swap), "zero_width": " ".join(words),
        "non_breaking_spaces": text.replace(" ", " "),
        "combined": " ".join(words).translate(swap)}
    assert robustness.round_trip(frame).where("restored <> variants").isEmpty()
    rows = robustness.robustness_rows(frame, MODEL)
    # Only the long-worded text is called ai; folded, it scores as before.
    assert rows.count() == 4 and rows.where("evaded_after_defence").isEmpty()
    summary = robustness.robustness_summary(rows).first()
    assert summary.attacked_variants == 4 and summary.eligible_original_ai_samples == 1
    assert summary.average_confidence_change_after_defence == pytest.approx(0)
    nothing = robustness.robustness_summary(rows.where("false")).first()
    assert nothing.attacked_variants == 0 and nothing.evasion_success_rate_before_defence is None
    assert robustness.clean_controls(frame, MODEL).first().clean_control_prediction_changes == 0


def test_texts_that_fold_back_are_scored_once(spark):
    counted = []

    def scorer(df, column, out):
        counted.append(df.where(F.col(column) != "").count())
        return df.withColumn(out, F.lit(0.9))

    frame = spark.createDataFrame([(1, "A plain sentence."), (2, "Another longer sentence here.")], "sample int, text string")
    assert robustness.robustness_rows(frame, scorer).count() == 8
    assert sum(counted) == 2 + 8


def test_upsert_reads_the_stored_metrics(spark):
    from quillstat.catalogue import QUERIES

    plan = QUERIES["level_upsert"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan
