"""Scoring texts and shaping the verdicts."""

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import style, text as tx
from ..functions.constants import BANDS, INTERVAL_METHOD
from ..functions.state import spread_by
from ..functions.text import hash_unit_key
from .corpus import label_name
from .evaluate import interval_of
from .running import running_total
from .sentences import display_sentences, whitespace_words
from .tfidf import BROADCAST_TERMS

# A scorer adds a probability column for a text column to any table. Keywords ``position`` and
# ``total`` are columns with the text's place among the sentences of its document.
Scorer = Callable[..., DataFrame]


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


@dataclass(frozen=True)
class StyleModel:
    """Linear model over style features of one text; scoring is a projection."""

    coefficients: Mapping[str, float]
    intercept: float

    def margin(self) -> Column:
        """The features first, in their order, the intercept last: a sum that should be zero then
        comes to zero or next to it, and its probability to 0.5."""
        first, *others = [F.col(f) * F.lit(float(w)) for f, w in self.coefficients.items()]
        return sum(others, first) + F.lit(float(self.intercept))

    def __call__(self, df: DataFrame, text_col: str, out: str, *, position: Column | None = None,
                 total: Column | None = None) -> DataFrame:
        names = list(self.coefficients)
        scored = style.stylometry(
            df.withColumn("_scored_text", F.col(text_col)), text_col="_scored_text", features=names,
            position=F.lit(0) if position is None else position, total=F.lit(1) if total is None else total,
        )
        return scored.withColumn(out, tx.computed_once(sigmoid(self.margin()))).drop("_scored_text", *names)


def linear_scores(long_weights: DataFrame, coefficients: DataFrame, *, intercept: float = 0.0,
                  id_col: str = "sample_id", terms: int | None = None) -> DataFrame:
    """Probability per row from a long feature table and ``term, coefficient``.

    ``terms`` bounds the number of coefficients. Up to ``BROADCAST_TERMS`` they are sent to every
    task, so that the long table is not shuffled by term; otherwise adaptive execution decides.
    """
    table = coefficients.select("term", "coefficient")
    if terms is not None and terms <= BROADCAST_TERMS:
        table = F.broadcast(table)
    z = F.sum(F.col("weight") * F.col("coefficient")) + F.lit(float(intercept))
    return (
        long_weights.join(table, "term").groupBy(id_col).agg(z.alias("margin"))
        .withColumn("ai_probability", sigmoid(F.col("margin")))
    )


def verdict(score: Column, score_type: Column | str = "ai_probability") -> Column:
    """1 at or above 0.5 for probabilities, at or above 0 for margins."""
    kind = F.lit(score_type) if isinstance(score_type, str) else score_type
    return (score >= F.when(kind == "ai_probability", 0.5).otherwise(0.0)).cast("int")


def confidence(probability: Column) -> Column:
    """Probability of the class that was chosen."""
    return F.when(probability >= 0.5, probability).otherwise(1.0 - probability)


def document_verdicts(scored: DataFrame, *, score_type: str = "ai_probability") -> DataFrame:
    """Verdict of each document from its mean sentence score."""
    return (
        scored.groupBy("doc_id")
        .agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("sentences"))
        .withColumn("numeric_label", verdict(F.col("score"), score_type))
        .withColumn("label", label_name(F.col("numeric_label")))
    )


def likelihood_band(label: Column, probability: Column) -> Column:
    """strong, moderate or low for texts labelled ai; human otherwise."""
    band = F.when(label != "ai", "human")
    for name, least in BANDS:
        band = band.when(probability >= least, name)
    return band.otherwise(BANDS[-1][0])


def whole_percent(probability: Column) -> Column:
    return F.floor(probability * 100 + 0.5)


def two_level_scores(df: DataFrame, *, sentence_scorer: Scorer, document_scorer: Scorer,
                     resamples: int = 1000, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Document verdict with all its sentence verdicts, for admitted texts.

    ``df`` has ``id_col, text``, already admitted, so a document has at most the admitted
    number of sentences and its result fits one row. Everything happens on the way of a
    row through one plan: fold, score the document, cut and score its sentences; only the
    scored sentences are shuffled, to gather them.
    """
    folded = df.select(id_col, "text").withColumn("normalised", tx.security_normalise(F.col("text")))
    shown = display_sentences(folded).withColumn("_clean", tx.clean_text(F.col("normalised")))
    whole = document_scorer(shown, "_clean", "ai_probability")
    parts = (
        whole.select(
            id_col, "ai_probability",
            (F.col("normalised") != tx.strip(F.col("text"))).alias("normalisation_applied"),
            tx.computed_once(F.arrays_zip(
                F.col("display").alias("shown"), tx.sentences(F.col("_clean")).alias("scored"))).alias("_pairs"),
            tx.computed_once(F.size(tx.sentences(F.col("_clean")))).alias("_count"))
        .select(id_col, "ai_probability", "normalisation_applied", "_count", F.posexplode("_pairs").alias("sent_id", "_s"))
        .select(id_col, "ai_probability", "normalisation_applied", "sent_id", "_count",
                F.col("_s.shown").alias("shown"), F.col("_s.scored").alias("scored"))
    )
    scored = sentence_scorer(
        parts, "scored", "score", position=F.col("sent_id"), total=F.col("_count")).select(
        id_col, "ai_probability", "normalisation_applied", "sent_id", "shown", "score")
    row = F.struct("sent_id", F.col("shown").alias("text"),
                   label_name(verdict(F.col("score"))).alias("label"),
                   F.col("score").alias("ai_probability"))
    p = F.col("ai_probability")
    gathered = spread_by(scored, id_col).groupBy(id_col).agg(
        F.first("ai_probability").alias("ai_probability"),
        F.first("normalisation_applied").alias("normalisation_applied"),
        F.sort_array(F.collect_list(row)).alias("_rows"),
    ).withColumn("_range", interval_of(resamples)(
        F.col("_rows.ai_probability"), hash_unit_key(F.col(id_col), seed=seed)))
    span = F.when(F.col("_range.lower").isNotNull(), F.struct(
        "_range.lower", "_range.upper",
        F.lit(INTERVAL_METHOD).alias("method"),
    ))
    return gathered.select(
        id_col, label_name(verdict(p)).alias("prediction"), p, confidence(p).alias("confidence"),
        span.alias("confidence_range"),
        F.transform("_rows", lambda r: F.struct(r["text"], r["label"], r["ai_probability"]))
        .alias("sentence_results"),
        "normalisation_applied",
    )


def session_log(scored: DataFrame, *, session: str, turn: str, text_col: str = "text",
                span: int = 4096) -> DataFrame:
    """Numbered checks of each session with whole percents, a preview and a word count.

    ``turn`` orders a session by a non-negative integer. Checks are numbered through spans
    of turns, so one endless session is not one task.
    """
    numbered = running_total(
        scored, keys=[session], bucket=F.floor(F.col(turn) / span), order=[turn],
        value=F.lit(1), out="check",
    )
    body = tx.strip(F.col(text_col))
    p = F.col("ai_probability")
    label = label_name(verdict(p))
    return numbered.select(
        session, turn, "check", label.alias("prediction"), p,
        whole_percent(p).alias("ai_percent"), confidence(p).alias("confidence"),
        likelihood_band(label, p).alias("band"),
        whitespace_words(F.col(text_col)).alias("word_count"),
        F.substring(body, 1, 40).alias("preview"), body.alias("full_text"),
    )


def band_counts(scored: DataFrame, *, band: str | None = None) -> DataFrame:
    """Rows per likelihood band, or of one chosen band."""
    label = label_name(verdict(F.col("score")))
    banded = scored.withColumn("band", likelihood_band(label, F.col("score")))
    if band is not None:
        banded = banded.where(F.col("band") == band)
    return banded.groupBy("band").agg(F.count(F.lit(1)).alias("rows"))
