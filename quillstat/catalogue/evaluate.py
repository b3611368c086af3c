"""Scoring, metric, interval and reporting queries."""

from pyspark.sql import functions as F

from ..functions.state import cut_lineage
from ..functions.text import hash_unit_key
from ..operators import evaluate, models, scoring, split, tfidf
from ..operators.sentences import split_runtime
from ..plans import training
from ..sources import sinks
from . import sqltext as q
from .features import TFIDF, sql_split
from .registry import MODEL, MODEL_B, SENTENCE_MODEL, Tables, query


@query("class_weights", f"""SELECT label, count(*) AS rows, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
    FROM {q.LABELLED} GROUP BY label""")
def class_weights(t: Tables):
    return models.class_weights(t.labelled())


_COEF = f"({q.hash_key('term', 'w')}) / 4294967296.0::DOUBLE - 0.5"


@query("score_linear", f"""WITH {TFIDF} SELECT sample_id, round(z, 6) AS margin, round(1 / (1 + exp(-z)), 6) AS ai_probability
    FROM (SELECT sample_id, sum(weight * ({_COEF})) + 0.1 AS z FROM weights GROUP BY sample_id)""")
def score_linear(t: Tables):
    """Coefficients are drawn per vocabulary term, so SQL can repeat them."""
    vocab, weights = tfidf.tfidf(t.documents.select(F.col("doc_id").alias("sample_id"), "text"))
    coefficients = vocab.select(
        "term", (hash_unit_key(F.col("term"), seed="w") / 4294967296.0 - 0.5).alias("coefficient"))
    scored = scoring.linear_scores(weights, coefficients, intercept=0.1, terms=20_000)
    return scored.select("sample_id", *[F.round(c, 6).alias(c) for c in ("margin", "ai_probability")])


SENTENCES = q.sentences("documents", "doc_id")
SCORED_SENTENCES = q.scored(SENTENCES, "doc_id, sent_id", MODEL)


def scored_sentences(t: Tables, labelled: bool = False):
    return MODEL(t.sentences(labelled=labelled), "text", "score")


@query("verdict_sentence_mean", f"""SELECT doc_id, round(avg(score), 6) AS score, count(*) AS sentences,
    CASE WHEN avg(score) >= 0.5 THEN 1 ELSE 0 END AS numeric_label,
    CASE WHEN avg(score) >= 0.5 THEN 'ai' ELSE 'human' END AS label FROM {SCORED_SENTENCES} GROUP BY doc_id""")
def verdict_sentence_mean(t: Tables):
    return scoring.document_verdicts(scored_sentences(t)).withColumn("score", F.round("score", 6))


_DOC_SCORES = q.scored(f"(SELECT doc_id, {q.collapse('text')} AS text FROM documents)", "doc_id", MODEL)


@query("confidence", f"""SELECT doc_id, round(score, 6) AS ai_probability,
    CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS numeric_label,
    round(CASE WHEN score >= 0.5 THEN score ELSE 1 - score END, 6) AS confidence,
    CASE WHEN ln(score / (1 - score)) >= 0 THEN 1 ELSE 0 END AS margin_label FROM {_DOC_SCORES}""")
def confidence(t: Tables):
    from .registry import cleaned

    scored = MODEL(cleaned(t.documents.select("doc_id", "text")), "text", "p")
    margin = F.log(F.col("p") / (1.0 - F.col("p")))
    return scored.select(
        "doc_id", F.round("p", 6).alias("ai_probability"),
        scoring.verdict(F.col("p")).alias("numeric_label"),
        F.round(scoring.confidence(F.col("p")), 6).alias("confidence"),
        scoring.verdict(margin, "ai_decision_score").alias("margin_label"))


def sql_bootstrap(scores: str, key: str = "doc_id") -> str:
    """Interval rows ``key, lower, upper`` of a score table, 1000 resamples."""
    p = 2_147_483_647
    return f"""(WITH lists AS (SELECT {key}, list(score ORDER BY sent_id) AS v, count(*) AS n, {q.hash_key(key)} AS s
        FROM {scores} GROUP BY {key}),
      u AS (SELECT {key}, v, n, b, unnest(range(n)) AS i, s FROM lists, range(1000) r(b) WHERE n >= 2),
      m0 AS (SELECT {key}, v, n, b, (s + b * 1000003 + i * 7919) % {p} AS u FROM u),
      m1 AS (SELECT *, (u * u + 12345) % {p} AS x FROM m0),
      m2 AS (SELECT *, (x * x + u) % {p} AS w FROM m1),
      means AS (SELECT {key}, b, avg(v[((w * w + x) % {p}) % n + 1]) AS mean FROM m2 GROUP BY {key}, b),
      spans AS (SELECT {key}, quantile_cont(mean, 0.025) AS lower, quantile_cont(mean, 0.975) AS upper FROM means GROUP BY {key})
      SELECT lists.{key}, lower, upper FROM lists LEFT JOIN spans ON lists.{key} = spans.{key})"""


@query("bootstrap_interval", f"""SELECT doc_id, round(lower, 6) AS lower, round(upper, 6) AS upper
    FROM {sql_bootstrap(SCORED_SENTENCES)}""")
def bootstrap_interval(t: Tables):
    ranges = evaluate.bootstrap_interval(scored_sentences(t).select("doc_id", "sent_id", "score"))
    return ranges.select("doc_id", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


class _StyleScorer:
    """The fixed model in the place of a trained one."""

    def __call__(self, df, text_col, out, **place):
        return MODEL(df, text_col, out, **place)

    def score_sentences(self, df):
        return MODEL(split_runtime(df), "text", "score").select("doc_id", "sent_id", "text", "score")


@query("predictions", f"""WITH s AS MATERIALIZED (SELECT * FROM {SCORED_SENTENCES}), m AS (SELECT doc_id, avg(score) AS score, count(*) AS sentences FROM s GROUP BY doc_id)
    SELECT m.doc_id, round(score, 6) AS score, sentences, CASE WHEN score >= 0.5 THEN 'ai' ELSE 'human' END AS label,
      round(lower, 6) AS lower, round(upper, 6) AS upper, NULL AS reject_code FROM m JOIN {sql_bootstrap('s')} b ON m.doc_id = b.doc_id
    UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, NULL, CASE WHEN c = '' THEN 'EMPTY_TEXT' ELSE 'NO_WORDS' END
    FROM (SELECT doc_id, coalesce({q.collapse('text')}, '') AS c FROM documents) WHERE NOT regexp_matches(c, '{q.W}')""")
def predictions(t: Tables):
    """Every text: its verdict with interval, or why it has none."""
    verdicts, _, rejected = training.predictions(_StyleScorer(), t.documents.select("doc_id", "text"))
    found = verdicts.select("doc_id", *[F.round(c, 6).alias(c) for c in ("score", "lower", "upper")], "sentences", "label")
    return found.unionByName(rejected.select("doc_id", "reject_code"), allowMissingColumns=True)


_BAND = "CASE WHEN score >= 0.9 THEN 'strong' WHEN score >= 0.7 THEN 'moderate' WHEN score >= 0.5 THEN 'low' ELSE 'human' END"


@query("likelihood_bands", f"SELECT band, count(*) AS rows FROM (SELECT {_BAND} AS band FROM {SCORED_SENTENCES}) GROUP BY band")
def likelihood_bands(t: Tables):
    return scoring.band_counts(scored_sentences(t))


@query("band_filter", f"SELECT 'moderate' AS band, count(*) AS rows FROM {SCORED_SENTENCES} WHERE ({_BAND}) = 'moderate'")
def band_filter(t: Tables):
    return scoring.band_counts(scored_sentences(t), band="moderate")


_PREDICTED = f"""(SELECT s.doc_id, s.sent_id, l.label, l.source, l.prompt, l.text, 'Logistic Regression' AS model, score, {sql_split('s.doc_id')} AS split
    FROM {q.scored(q.LABELLED_SENTENCES, 'doc_id, sent_id', MODEL)} s JOIN {q.LABELLED_SENTENCES} l ON s.doc_id = l.doc_id AND s.sent_id = l.sent_id
  UNION ALL SELECT s.doc_id, s.sent_id, l.label, l.source, l.prompt, l.text, 'Linear SVM', score, {sql_split('s.doc_id')}
    FROM {q.scored(q.LABELLED_SENTENCES, 'doc_id, sent_id', MODEL_B)} s JOIN {q.LABELLED_SENTENCES} l ON s.doc_id = l.doc_id AND s.sent_id = l.sent_id)"""


def _predicted(t: Tables):
    rows = split.split_documents(t.sentences())
    both = None
    for name, model in (("Logistic Regression", MODEL), ("Linear SVM", MODEL_B)):
        scored = model(rows, "text", "score").withColumns(
            {"model": F.lit(name), "prediction": scoring.verdict(F.col("score"))})
        both = scored if both is None else both.unionByName(scored)
    return both


_METRICS = f"""(SELECT model, split, n_right / n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
    FROM (SELECT model, split, count(*) AS n, count(*) FILTER ((score >= 0.5) = (label = 1)) AS n_right,
      count(*) FILTER (score >= 0.5 AND label = 1) AS tp, count(*) FILTER (score >= 0.5 AND label = 0) AS fp,
      count(*) FILTER (score < 0.5 AND label = 1) AS fn FROM {_PREDICTED} GROUP BY model, split))"""


@query("binary_metrics", f"SELECT * FROM {_METRICS}")
def binary_metrics(t: Tables):
    return evaluate.binary_metrics(_predicted(t))


@query("prediction_trace", f"""SELECT cast(doc_id AS VARCHAR) || ':' || cast(sent_id AS VARCHAR) AS sample_id, doc_id, sent_id, source, prompt, text,
    CASE label WHEN 1 THEN 'ai' ELSE 'human' END AS true_label, CASE WHEN score >= 0.5 THEN 'ai' ELSE 'human' END AS predicted_label,
    model, round(score, 6) AS score, 'ai_probability' AS score_type, split FROM {_PREDICTED} WHERE split = 'test'""")
def prediction_trace(t: Tables):
    from ..operators.corpus import with_sample_id

    scored = with_sample_id(_predicted(t).where("split = 'test'"))
    stacked = None
    for name in ("Logistic Regression", "Linear SVM"):
        trace = evaluate.prediction_trace(scored.where(F.col("model") == name), model=name, split="test")
        stacked = trace if stacked is None else stacked.unionByName(trace)
    return stacked.withColumn("score", F.round("score", 6))


@query("model_select", f"SELECT model, f1, accuracy FROM {_METRICS} WHERE split = 'validation' ORDER BY f1 DESC, accuracy DESC, model DESC LIMIT 1")
def model_select(t: Tables):
    metrics = evaluate.binary_metrics(_predicted(t)).where("split = 'validation'")
    return evaluate.select_model(metrics).select("model", "f1", "accuracy")


@query("level_upsert", f"""SELECT model, split, f1, CASE split WHEN 'test' THEN 'document' ELSE 'sentence' END AS unit
    FROM {_METRICS} WHERE split IN ('test', 'validation')""")
def level_upsert(t: Tables):
    """Old rows of both units are there; the test rows replace those of one unit."""
    # Six rows, stored: they are read three times, and each reading would score all sentences again.
    metrics = cut_lineage(evaluate.binary_metrics(_predicted(t)).select("model", "split", "f1"))
    previous = metrics.where("split = 'validation'").withColumn("unit", F.lit("sentence")).unionByName(
        metrics.where("split = 'train'").withColumn("unit", F.lit("document")))
    new = metrics.where("split = 'test'").withColumn("unit", F.lit("document"))
    return evaluate.upsert(previous, new, key="unit")


@query("score_differences", f"""SELECT count(*) AS differences FROM (SELECT 1 FROM
    {q.scored(q.LABELLED_SENTENCES, 'doc_id, sent_id', MODEL)} a JOIN {q.scored(q.LABELLED_SENTENCES, 'doc_id, sent_id', MODEL_B)} b
    ON a.doc_id = b.doc_id AND a.sent_id = b.sent_id WHERE (a.score >= 0.5) <> (b.score >= 0.5))""")
def score_differences(t: Tables):
    """The reload check, between two different models."""
    from ..operators.corpus import with_sample_id

    rows = with_sample_id(_predicted(t))
    first, second = (rows.where(F.col("model") == m) for m in ("Logistic Regression", "Linear SVM"))
    n = sinks.count_differences(first, second, key="sample_id", value="prediction")
    return t.spark.createDataFrame([(n,)], "differences long")


_TURNS = "(SELECT conv_id, turn, text FROM conversations)"


@query("session_log", f"""SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS "check",
    CASE WHEN score >= 0.5 THEN 'ai' ELSE 'human' END AS prediction, round(score, 6) AS ai_probability,
    floor(score * 100 + 0.5)::BIGINT AS ai_percent,
    round(CASE WHEN score >= 0.5 THEN score ELSE 1 - score END, 6) AS confidence, {_BAND} AS band,
    len(list_filter(string_split({q.collapse('text')}, ' '), lambda x: x <> '')) AS word_count,
    substr({q.strip('text')}, 1, 40) AS preview, {q.strip('text')} AS full_text
    FROM {q.scored(_TURNS, 'conv_id, turn, text', MODEL)}""")
def session_log(t: Tables):
    turns = t.conversations.select("conv_id", "turn", "text")
    scored = MODEL(turns, "text", "ai_probability")
    log = scoring.session_log(scored, session="conv_id", turn="turn")
    return log.withColumns({c: F.round(c, 6) for c in ("ai_probability", "confidence")})


# ---- Two-level scoring of admitted documents ----------------------------------------

from .quality import _CODE  # noqa: E402

ADMITTED = f"""(SELECT doc_id, text FROM (SELECT doc_id, text, {_CODE} AS code FROM (
    SELECT *, {q.sentence_list(q.collapse('text'))} AS p FROM documents)) WHERE code IS NULL)"""
_FOLDED = f"(SELECT doc_id, text, {q.folded('text')} AS folded FROM {ADMITTED})"
_WHOLE = q.scored(_FOLDED, "doc_id", MODEL_B, text="folded", out="p")
_PARTS = f"""(SELECT doc_id, len(p) AS sentences_, unnest(range(len(p))) AS sent_id, unnest(p) AS text FROM (
    SELECT doc_id, {q.sentence_list('folded')} AS p FROM {_FOLDED}))"""
_PART_SCORES = q.scored(_PARTS, "doc_id, sent_id, text", SENTENCE_MODEL, pos="sent_id", total="sentences_")
TWO_LEVEL = f"""WITH w AS {_WHOLE}, ps AS {_PART_SCORES}, r AS {sql_bootstrap('ps')},
  g AS (SELECT doc_id, count(*) AS sentences, string_agg(CASE WHEN score >= 0.5 THEN 'ai' ELSE 'human' END, ',' ORDER BY sent_id) AS labels,
    md5(string_agg(text, '|' ORDER BY sent_id)) AS shown_md5, sum(score) AS total FROM ps GROUP BY doc_id)
  SELECT doc_id, CASE WHEN p >= 0.5 THEN 'ai' ELSE 'human' END AS prediction, round(p, 6) AS ai_probability,
    round(CASE WHEN p >= 0.5 THEN p ELSE 1 - p END, 6) AS confidence, round(lower, 6) AS lower, round(upper, 6) AS upper,
    sentences, labels, shown_md5, round(total, 6) AS sentence_total,
    (SELECT f.folded <> {q.strip('f.text')} FROM {_FOLDED} f WHERE f.doc_id = w.doc_id) AS normalisation_applied
  FROM w JOIN g USING (doc_id) JOIN r USING (doc_id)"""


def flattened(scored):
    """The nested verdicts as comparable columns."""
    rows = F.col("sentence_results")
    return scored.select(
        "doc_id", "prediction", F.round("ai_probability", 6).alias("ai_probability"),
        F.round("confidence", 6).alias("confidence"),
        F.round("confidence_range.lower", 6).alias("lower"), F.round("confidence_range.upper", 6).alias("upper"),
        F.size(rows).alias("sentences"), F.array_join(rows["label"], ",").alias("labels"),
        F.md5(F.array_join(F.transform(rows["text"], lambda s: F.regexp_replace(s, q.WS + "+", " ")), "|")).alias("shown_md5"),
        F.round(F.aggregate(rows["ai_probability"], F.lit(0.0), lambda a, x: a + x), 6).alias("sentence_total"),
        "normalisation_applied")


@query("two_level_scores", TWO_LEVEL)
def two_level_scores(t: Tables):
    from ..plans.scoring import score_batch

    scored, _ = score_batch(
        t.documents.select("doc_id", "text"), sentence_scorer=SENTENCE_MODEL, document_scorer=MODEL_B)
    return flattened(scored)
