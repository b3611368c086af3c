"""Where recoverable intermediate state is kept."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Only a local session without one (tests, a laptop) gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="quillstat-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    root = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    A checkpoint keeps Spark's estimate of its size. Joins multiply estimates, so over loops of joins
    they become numbers of megabytes on the driver; a stored table has the size of its files.
    """
    path = f"{checkpoint_root(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_by(df: DataFrame, *keys) -> DataFrame:
    """Hash rows over all shuffle partitions.

    For steps that are heavy in work but light in bytes: adaptive execution would merge
    their partitions by size, but keeps an explicit number.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
