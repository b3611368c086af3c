"""Table access, written intermediate tables and the registry of this subpackage."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.state import checkpoint_root
from ..session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: White space that separates words in the contracts, as a Java character class.
BLANKS = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    """Register ``(spark, folder) -> DataFrame`` beside its SQL twin, if it has one."""
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; an input with fewer splits than cores is spread over them."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def new_folder(spark: SparkSession, what: str) -> str:
    """A path in the shared folder of ``spark.checkpoint.dir`` that nothing uses yet."""
    return f"{checkpoint_root(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str, **options) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: it is computed once,
    and its reader survives the loss of executors. The folder is left to the cluster's
    retention of ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    path = new_folder(spark, what)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Only A-Z change; ``lower`` would change other letters too."""
    return F.translate(text, UPPER, LOWER)
