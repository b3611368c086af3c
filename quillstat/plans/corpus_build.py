"""The corpus builds: raw corpora to a sentence table and a document table."""

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import CORPUS_LABELS
from ..functions.state import cut_lineage
from ..operators import cleaning, corpus, features
from ..operators.running import dense_index
from ..sources import readers, sinks


def prepare_source(df: DataFrame, *, order: str) -> DataFrame:
    """Clean one corpus, drop missing rows and repeated texts. ``order`` ranks its rows."""
    cleaned = cleaning.clean_corpus(df.withColumn("row_ord", F.col(order)))
    present = cleaning.drop_missing(cleaned)
    return corpus.keep_first(
        present.select("text", "label", "source", "prompt", "row_ord"), order=["row_ord"])


def merge_sources(sources: list[DataFrame]) -> DataFrame:
    """Merge prepared corpora; the first copy of a text wins, invalid entries go."""
    merged = corpus.keep_first(
        corpus.merge_corpora(sources), order=["source_rank", "row_ord"])
    return cleaning.drop_invalid(merged)


def number_documents(merged: DataFrame) -> DataFrame:
    """Dense ``doc_id`` in the order of the inputs.

    The merged corpus is materialised: numbering reads it twice, and cleaning it again
    would cost more than storing it.
    """
    return dense_index(cut_lineage(merged), order=["source_rank", "row_ord"], out="doc_id").drop(
        "source_rank", "row_ord")


def sentence_corpus(documents: DataFrame) -> DataFrame:
    return features.corpus_sentence_features(documents)


def document_corpus(documents: DataFrame) -> DataFrame:
    """One row per document with stored features and ``sent_id`` 0."""
    return features.document_features(
        documents.withColumn("sent_id", F.lit(0)), rounded=True, clean=False)


def rows_in_order(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored corpus with ``row_ord``, their place in its files."""
    raw = readers.read_table(spark, path).drop("doc_id", "sent_id")
    return corpus.with_keys(raw, id_column=None).withColumnRenamed("doc_id", "row_ord").drop("sent_id")


def build_corpus(spark: SparkSession, base: str, extras: Sequence[str], output: str, *,
                 unit: str = "sentence", mapping: Mapping[str, int] = CORPUS_LABELS) -> DataFrame:
    """From stored corpora to the stored feature table of one unit, which is returned.

    The base has ``text, label, source`` and a prompt; extras name text and label in their own
    way, take their file's name as source and spell labels as ``mapping`` says.
    """
    if unit not in {"sentence", "document"}:
        raise ValueError(f"unit {unit!r}: a corpus has sentence or document rows")
    first = readers.base_corpus(rows_in_order(spark, base), keep=["row_ord"])
    frames = [first.withColumn("label", F.col("label").try_cast("double").cast("int"))]
    for path in extras:
        name = os.path.basename(path.rstrip("/"))
        named = readers.resolve_columns(rows_in_order(spark, path), name=name, keep=["row_ord"])
        mapped = corpus.map_corpus_labels(corpus.numeric_ids(named, ["label"]), mapping=mapping)
        frames.append(corpus.tag_source(mapped, source=os.path.splitext(name)[0]))
    merged = merge_sources([prepare_source(f, order="row_ord") for f in frames])
    table = sentence_corpus if unit == "sentence" else document_corpus
    sinks.write_table(table(number_documents(merged)), output)
    return spark.read.parquet(output)
