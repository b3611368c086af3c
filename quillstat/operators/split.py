"""Document-grouped splits and seeded samples."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.state import cut_lineage
from ..functions.text import hash_unit_key
from .running import hash_rank, take_smallest

_SPAN = float(2 ** 32)


def check_shares(test_size: float, validation_size: float) -> None:
    train = 1 - test_size - validation_size
    if min(test_size, validation_size, train) <= 0:
        raise ValueError(f"test, validation and training shares must be above 0: {test_size}, {validation_size}, {train}")


def hash_split(doc_id: Column, *, seed: int = 42, test_size: float = 0.15,
               validation_size: float = 0.15) -> Column:
    """Split name from the document key alone: no shuffle, and the same in a stream."""
    check_shares(test_size, validation_size)
    u = hash_unit_key(doc_id, seed=seed) / F.lit(_SPAN)
    return (F.when(u < test_size, "test").when(u < test_size + validation_size, "validation")
            .otherwise("train"))


def split_documents(df: DataFrame, *, seed: int = 42, test_size: float = 0.15,
                    validation_size: float = 0.15) -> DataFrame:
    """Default split: every row of a document follows the hash of its key."""
    return df.withColumn("split", hash_split(
        F.col("doc_id"), seed=seed, test_size=test_size, validation_size=validation_size))


def _quota(sizes: DataFrame, *, size_col: str, share: float, out: str) -> DataFrame:
    """Rows of each label in a part of ``ceil(total * share)``, by largest remainder.

    ``sizes`` has one row per label.
    """
    everything = Window.partitionBy(F.lit(0))
    wanted = F.ceil(F.round(F.sum(size_col).over(everything) * F.lit(share), 6))
    exact = F.col("_wanted") * F.col(size_col) / F.sum(size_col).over(everything)
    by_remainder = everything.orderBy(F.col("_exact") - F.floor("_exact"), "label")
    return (
        sizes.withColumn("_wanted", wanted)
        .withColumn("_exact", exact)
        .withColumn("_spare", F.col("_wanted") - F.sum(F.floor("_exact")).over(everything))
        .withColumn("_place", F.count(F.lit(1)).over(everything) - F.row_number().over(by_remainder))
        .withColumn(out, F.floor("_exact") + (F.col("_place") < F.col("_spare")).cast("long"))
        .drop("_wanted", "_exact", "_spare", "_place")
    )


def exact_split(df: DataFrame, *, seed: int = 42, test_size: float = 0.15,
                validation_size: float = 0.15) -> DataFrame:
    """Stratified split with exact part sizes.

    The test part has ``ceil(n * test)`` documents and the validation part ``ceil`` of its
    share of the rest, both divided over the labels in proportion. Documents are ranked by
    hash inside their label through hash buckets, so two labels do not mean two tasks.
    """
    check_shares(test_size, validation_size)
    # One narrow row a document, stored: ranks and sizes do not read the table again.
    documents = cut_lineage(
        df.groupBy("doc_id").agg(F.min("label").alias("label"))
        .withColumn("_key", hash_unit_key(F.col("doc_id"), seed=seed))
    )
    ranked = hash_rank(documents, keys=["label"], hash_key="_key", tie=["doc_id"])
    sizes = documents.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    sizes = _quota(sizes, size_col="_n", share=test_size, out="_test")
    sizes = _quota(sizes.withColumn("_rest", F.col("_n") - F.col("_test")), size_col="_rest",
                   share=validation_size / (1 - test_size), out="_validation")
    named = ranked.join(sizes, "label").select(
        "doc_id",
        F.when(F.col("rank") <= F.col("_test"), "test")
        .when(F.col("rank") <= F.col("_test") + F.col("_validation"), "validation")
        .otherwise("train").alias("split"),
    )
    return df.join(named, "doc_id")


def split_summary(df: DataFrame) -> DataFrame:
    """Rows and distinct documents per split, from one row per document."""
    per_document = df.groupBy("split", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_document.groupBy("split").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("documents"))


def split_leaks(df: DataFrame) -> DataFrame:
    """Documents present in more than one split (empty when the split is sound)."""
    return (
        df.groupBy("doc_id")
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"))
        .where("first_split <> last_split")
    )


def sample_rows(df: DataFrame, *, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows without replacement, in hash order of their keys."""
    hashed = df.withColumn("_key", hash_unit_key(*[F.col(k) for k in keys], seed=seed))
    return take_smallest(hashed, n=n, hash_key="_key", tie=keys).drop("_key")


def examples_per_group(df: DataFrame, *, group: str, keys: list[str], n: int = 5,
                       seed: int = 42) -> DataFrame:
    """Up to ``n`` rows per group. Spark limits the groups before the shuffle, so a group
    with a third of the rows sends ``n`` rows per task."""
    order = Window.partitionBy(group).orderBy("_key", *keys)
    return (
        df.withColumn("_key", hash_unit_key(*[F.col(k) for k in keys], seed=seed))
        .withColumn("example", F.row_number().over(order))
        .where(F.col("example") <= n).drop("_key")
    )
