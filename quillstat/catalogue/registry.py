"""Registration, table access and the frames several queries share."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators.scoring import StyleModel
from ..operators.sentences import split_runtime
from ..session import ship_package
from ..sources.readers import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# A fixed linear model, so that scoring can be repeated in SQL.
MODEL = StyleModel(
    {"avg_word_len": 0.9, "vocab_div_ratio": -2.5, "complex_word_ratio": 1.5,
     "stopword_ratio": -1.25, "upper_letter_ratio": 4.0, "char_entropy": 0.4,
     "rep_bigram": 3.0, "semicolon_dash_count": -0.05},
    -3.9,
)
# For sentences: their place in the document counts too.
SENTENCE_MODEL = StyleModel({**MODEL.coefficients, "doc_pos": 0.8}, -4.2)
# A second one, for comparisons between models.
MODEL_B = StyleModel({"avg_word_len": -0.6, "complex_word_ratio": 2.0, "char_entropy": 0.8}, -0.9)


def query(name: str, sql: str | None = None):
    """Register a ``(tables) -> DataFrame`` function; ``tables`` loads by name."""
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


class Tables:
    """The driver tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def documents(self) -> DataFrame:
        """The texts, on all cores however few row groups the file has."""
        return spread(self.stored_documents())

    def stored_documents(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/documents.parquet")

    def corpus(self) -> DataFrame:
        """Documents with provenance and, where known, a label."""
        labels = self.labels.select("doc_id", F.col("quality").alias("label"))
        return self.documents.join(labels, "doc_id", "left").select(
            "doc_id", "text", "label", "source", F.col("lang").alias("prompt"))

    def labelled(self) -> DataFrame:
        labels = self.labels.select("doc_id", F.col("quality").alias("label"))
        return self.documents.join(labels, "doc_id").select(
            "doc_id", "text", "label", "source", F.col("lang").alias("prompt"))

    def chats(self) -> DataFrame:
        """Conversation turns as an extra corpus: role is the raw label."""
        return self.conversations.select(
            "conv_id", "turn", "text", F.col("role").alias("label"),
            F.lit("conversations").alias("source"), F.lit("unknown").alias("prompt"),
            (F.shiftleft("conv_id", 20) + F.col("turn")).alias("row_ord"))

    def sentences(self, labelled: bool = True) -> DataFrame:
        """Sentence rows ``doc_id, [label, source, prompt,] total, sent_id, text``."""
        docs = self.labelled() if labelled else self.documents.select("doc_id", "text")
        return split_runtime(docs)


def cleaned(df: DataFrame) -> DataFrame:
    return df.withColumn("text", clean_text(F.col("text")))
