"""Sentence generators and text counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chars, style, text as tx


def split_runtime(df: DataFrame, *, text_col: str = "text", clean: bool = True) -> DataFrame:
    """One row per sentence: word-less parts dropped first, then numbered from 0.

    ``total`` is the document's sentence count. A row is exploded where it is, so the
    step moves no data. Spark keeps empty arrays out by a filter below the explosion, which
    would clean and cut every text twice more if the array were not computed once. The array is
    counted before the explosion: counted after it, every sentence would carry all of its document.
    """
    text = F.col(text_col)
    body = tx.clean_text(text) if clean else text
    keep = [c for c in df.columns if c != text_col]
    return (
        df.withColumn("_body", body)
        .select(*keep, tx.computed_once(tx.sentences(F.col("_body"))).alias("_parts"))
        .select(*keep, tx.computed_once(F.size("_parts")).alias("total"), "_parts")
        .select(*keep, "total", F.posexplode("_parts").alias("sent_id", text_col))
    )


def split_corpus(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """One row per sentence: all non-blank parts numbered, then word-less ones dropped.

    Numbers may have gaps and ``total`` counts the dropped parts, as in the stored corpus.
    """
    keep = [c for c in df.columns if c != text_col]
    parts = F.filter(tx.split_gaps(tx.strip(F.col(text_col))), lambda p: F.length(p) > 0)
    return (
        df.select(*keep, tx.computed_once(parts).alias("_parts"))
        .select(*keep, tx.computed_once(F.size("_parts")).alias("total"), "_parts")
        .select(*keep, "total", F.posexplode("_parts").alias("sent_id", text_col))
        .where(tx.has_word(F.col(text_col)))
    )


def words_and_bigrams(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Arrays of words and of lower-case adjacent pairs."""
    return df.withColumn("words", tx.words(F.col(text_col))).withColumn(
        "bigrams", style.word_bigrams(F.transform("words", F.lower)))


def whitespace_words(text: Column) -> Column:
    """Words as a form shows them: split on whitespace."""
    return F.size(F.filter(F.split(text, chars.WS + "+"), lambda w: F.length(w) > 0))


def text_counts(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Characters, UTF-8 bytes, whitespace words and sentence-like parts."""
    text = F.col(text_col)
    parts = F.filter(tx.split_gaps(tx.strip(text)), lambda p: F.length(p) > 0)
    return df.withColumns({
        "characters": F.length(text),
        "bytes": F.octet_length(text),
        "whitespace_words": whitespace_words(text),
        "sentence_count": F.size(parts),
    })


def display_sentences(df: DataFrame, *, original: str = "text", normalised: str = "normalised") -> DataFrame:
    """Sentences to show beside the scored ones.

    The submitted characters are kept when the original splits into as many sentences as
    the normalised text; otherwise the normalised sentences are shown.
    """
    return (
        df.withColumns({
            "_shown": tx.sentences(tx.strip(F.col(original))),
            "_scored": tx.sentences(tx.clean_text(F.col(normalised))),
        })
        .withColumn("display", F.when(F.size("_shown") == F.size("_scored"), F.col("_shown"))
                    .otherwise(F.col("_scored")))
        .withColumn("aligned", F.size("_shown") == F.size("_scored"))
        .drop("_shown", "_scored")
    )
