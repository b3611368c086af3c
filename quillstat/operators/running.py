"""Ordered totals, ranks and dense numbers without one global or per-key window.

A window over one hot key, or over no key at all, is a single task. Here rows are first
cut into ordered buckets; a window numbers the rows inside a bucket, a second window runs
over one total per bucket, and an equi-join adds the two.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.state import cut_lineage

_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_BEFORE_HERE = (Window.unboundedPreceding, -1)


def running_total(
    df: DataFrame, *, keys: list[str], bucket: Column, order: list, value: Column, out: str
) -> DataFrame:
    """Inclusive running sum of ``value`` per ``keys`` in ``order``.

    ``bucket`` must be a function of the row that never decreases along ``order``.
    """
    cut = df.withColumns({"_bucket": bucket, "_value": value})
    offsets = bucket_offsets(
        cut.groupBy(*keys, "_bucket").agg(F.sum("_value").alias("_sum")), keys=keys
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(*_UP_TO_HERE)
    local = cut.withColumn("_inside", F.sum("_value").over(inside))
    return (
        local.join(offsets, [*keys, "_bucket"])
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .select(*[c for c in df.columns if c != out], out)
    )


def bucket_offsets(sums: DataFrame, *, keys: list[str]) -> DataFrame:
    """``keys, _bucket, _offset``: total of the buckets before each; one row per bucket."""
    across = (
        (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
        .orderBy("_bucket").rowsBetween(*_BEFORE_HERE)
    )
    return sums.select(
        *keys, "_bucket", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_offset")
    )


def hash_rank(
    df: DataFrame, *, keys: list[str], hash_key: str, tie: list[str], out: str = "rank",
    bits: int = 10,
) -> DataFrame:
    """1-based rank by a uniform 32-bit hash; its leading ``bits`` are the buckets."""
    return running_total(
        df, keys=keys, bucket=F.shiftright(hash_key, 32 - bits),
        order=[hash_key, *tie], value=F.lit(1), out=out,
    )


def take_smallest(
    df: DataFrame, *, n: int, hash_key: str, tie: list[str], bits: int = 12
) -> DataFrame:
    """The ``n`` rows with the smallest hashes, chosen without a single-task top-k.

    Counts per hash bucket (2**bits rows, hence the broadcast) tell which buckets lie
    wholly outside; only the remaining rows are shuffled and numbered.
    """
    cut = df.withColumn("_bucket", F.shiftright(hash_key, 32 - bits))
    offsets = bucket_offsets(
        cut.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_sum")), keys=[]
    ).where(F.col("_offset") < n)
    inside = Window.partitionBy("_bucket").orderBy(hash_key, *tie)
    return (
        cut.join(F.broadcast(offsets), "_bucket")
        .withColumn("_rank", F.row_number().over(inside) + F.col("_offset"))
        .where(F.col("_rank") <= n)
        .select(*df.columns)
    )


def dense_index(
    df: DataFrame, *, order: list[str], out: str = "doc_id", partitions: int | None = None
) -> DataFrame:
    """Number rows 0..n-1 in ``order`` (whose columns identify a row).

    Only the ordering columns are range-sorted. The sort is checkpointed before its
    partitions are counted, because a repeated range sort may cut elsewhere. There is one
    offset per partition, so that side of the join is small by construction.
    """
    keys = df.select(*order)
    spread = (
        keys.repartitionByRange(partitions, *order) if partitions
        else keys.repartitionByRange(*order)
    )
    ordered = cut_lineage(
        spread.sortWithinPartitions(*order).select(
            *order,
            F.spark_partition_id().alias("_bucket"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_inside"),
        )
    )
    offsets = bucket_offsets(
        ordered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_sum")), keys=[]
    )
    numbered = ordered.join(F.broadcast(offsets), "_bucket").select(
        *order, (F.col("_inside") + F.col("_offset")).alias(out)
    )
    return df.drop(out).join(numbered, order)


def exact_quantiles(
    df: DataFrame, *, by: list[str], value: str, probabilities: dict[str, float],
    weight: str | None = None, buckets: int | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, one column per name.

    The built-in ``percentile`` holds every distinct value of a group in one task. Here
    values are counted first (map-side; ``weight`` is a count already taken), the distinct ones
    are range-sorted and cumulated with one offset per partition, and only the few values at the
    wanted ranks are aggregated. ``buckets`` fixes the number of partitions. The sort is checkpointed because a repeated one may cut elsewhere.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_c"))
    order = [*by, "_v"]
    spread = counted.repartitionByRange(buckets, *order) if buckets else counted.repartitionByRange(*order)
    placed = cut_lineage(spread.withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy(*by).agg(F.sum("_c").alias("_n"))
    joined = placed.join(totals, by) if by else placed.withColumn("_n", totals.scalar())
    cumulated = running_total(
        joined, keys=by, bucket=F.col("_part"), order=["_v"], value=F.col("_c"), out="_cum")
    picks, results = [], []
    for name, p in probabilities.items():
        rank = (F.col("_n") - 1) * F.lit(float(p))
        picks += [
            F.min(F.when(F.col("_cum") > F.floor(rank), F.col("_v"))).alias(f"_{name}_a"),
            F.min(F.when(F.col("_cum") > F.ceil(rank), F.col("_v"))).alias(f"_{name}_b"),
        ]
        share = rank - F.floor(rank)
        results.append(
            (F.col(f"_{name}_a") + (F.col(f"_{name}_b") - F.col(f"_{name}_a")) * share).alias(name)
        )
    grouped = cumulated.groupBy(*by).agg(F.max("_n").alias("_n"), *picks)
    return grouped.select(*by, *results)
