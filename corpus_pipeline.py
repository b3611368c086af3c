"""From raw documents to a training mix: language, lines, near duplicates, leaks, source weights.

Each stage takes (spark, documents, folder of tables); all but the last return the columns of
documents. ``run`` writes every stage to the shared folder and reads it again.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstat.llm import common, decontaminate, jaccard_join, language, line_dedup, mixing
from quillstat.session import ship_package

#: A text of at least so many words is rejected if a smaller share of them is known to the model:
#: unlike a posterior, the share does not grow with the text. Texts without letters go too.
LEAST_KNOWN, LEAST_WORDS = 0.1, 20


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until the table has none of them."""
    while set(names) & set(docs.columns):
        names = tuple(f"{n}_" for n in names)
    return list(names)


def identified(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a language. The given label is an input of training only and stays as it is."""
    ship_package(spark)
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))).select("lang", "text", "doc_id"),
                         draw=F.xxhash64("doc_id", "text"))
    lang, score, known = _free(docs, "_lang", "_score", "_known")
    out = language.identify(docs, model, lang=lang, score=score, known=known)
    few = F.size(F.split("text", f"[{common.BLANKS}]+", LEAST_WORDS)) < LEAST_WORDS
    return out.filter((F.col(lang) != language.UNKNOWN) & (few | (F.col(known) >= LEAST_KNOWN))).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without later lines that resemble earlier ones; ``n_chars`` follows the text. Documents
    that lose all their words with these lines go; others stay, however short."""
    ship_package(spark)
    out = line_dedup.dedup_lines(docs)
    empty = (F.col("n_removed") > 0) & ~F.coalesce(F.col("text").rlike(f"[^{common.BLANKS}]"), F.lit(False))
    return out.filter(~empty).select(*[
        F.col(c) if c in ("doc_id", "text") else
        F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("rest")[c]).alias(c) if c == "n_chars" else
        F.col("rest")[c].alias(c) for c in docs.columns])


def one_of_each_class(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id; of rows that repeat
    it, one. Documents without words have no class and stay, but for repeated rows."""
    ship_package(spark)
    classes = jaccard_join.similar_classes(docs)
    lost = classes.filter(~F.col("first")).select(F.col("doc_id").alias("_lost"), F.col("th").alias("_of")).distinct()
    # Rows travel as one column, so that no name of theirs can meet a helper's.
    rows = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.struct(*docs.columns).alias("_row"))
    kept = rows.join(lost, (F.col("_text") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_lost")), "left_anti")
    same = Window.partitionBy("doc_id", "_text").orderBy("_text")
    return kept.withColumn("_n", F.row_number().over(same)).filter("_n = 1").select("_row.*")


def without_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands."""
    ship_package(spark)
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    spans, words = _free(docs, "_spans", "_words")
    found = decontaminate.find_leaks(docs, items, spans=spans, words=words)
    return found.filter(F.size(spans) == 0).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What the mix takes of each document: ``doc_id, size, source_size, target, taken``."""
    ship_package(spark)
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("language", identified),
    ("lines", without_repeated_lines),
    ("near_duplicates", one_of_each_class),
    ("benchmark", without_leaks),
    ("mix", mixed),
]

#: The joins of lines and documents and the cube method are not SQL; tests compare them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
