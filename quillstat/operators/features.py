"""Feature tables and the loader's feature repair."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import style, text as tx
from ..functions.constants import NUMERIC_FEATURES
from .sentences import split_corpus, split_runtime


def sentence_features(df: DataFrame, *, features=style.ALL_FEATURES, clean: bool = True) -> DataFrame:
    """Runtime sentence table: unrounded features, ``sample_id`` per sentence."""
    rows = split_runtime(df, clean=clean)
    return style.stylometry(
        rows, position=F.col("sent_id"), total=F.col("total"), features=features
    ).drop("total")


def document_features(df: DataFrame, *, features=NUMERIC_FEATURES, rounded: bool = False,
                      clean: bool = True) -> DataFrame:
    """One row per document, position 0 of 1; texts without a word are left out."""
    body = df.withColumn("text", tx.clean_text(F.col("text"))) if clean else df
    return style.stylometry(
        body.where(tx.has_word(F.col("text"))), features=features, rounded=rounded
    )


def wordless_documents(df: DataFrame) -> DataFrame:
    """Documents the feature table cannot hold."""
    return df.where(~tx.has_word(tx.clean_text(F.col("text"))))


def corpus_sentence_features(df: DataFrame) -> DataFrame:
    """The stored sentence corpus: gapped numbering and rounded features."""
    return style.stylometry(
        split_corpus(df), position=F.col("sent_id"), total=F.col("total"), rounded=True
    ).drop("total")


def last_sentence(df: DataFrame) -> DataFrame:
    """``doc_id, last_sent``: combined map-side, so a huge document is one row per task."""
    return df.groupBy("doc_id").agg(F.max("sent_id").alias("last_sent"))


def repair_position(df: DataFrame) -> DataFrame:
    """``doc_pos`` over the surviving sentences of each document."""
    return (
        df.join(last_sentence(df), "doc_id")
        .withColumn("doc_pos", F.col("sent_id") / F.greatest("last_sent", F.lit(1)))
    )


def repair_features(df: DataFrame) -> DataFrame:
    """Recompute position and mean word length; fill feature columns that are absent.

    Stored values of the other features are kept as they are.
    """
    missing = [f for f in NUMERIC_FEATURES if f not in df.columns]
    columns = list(df.columns)
    placed = repair_position(df)
    computed = list(dict.fromkeys([*missing, "avg_word_len"]))
    computed = [f for f in computed if f != "doc_pos"]
    filled = style.stylometry(
        placed, position=F.col("sent_id"), total=F.col("last_sent") + 1, features=computed
    )
    order = [c for c in columns if c not in NUMERIC_FEATURES]
    return filled.select(*order, *NUMERIC_FEATURES)
