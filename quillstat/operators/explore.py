"""Exploratory aggregates over labelled feature tables."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import HISTOGRAM_FEATURES, NUMERIC_FEATURES
from ..functions.state import cut_lineage
from .running import exact_quantiles
from .scaling import long_features


def class_balance(df: DataFrame) -> DataFrame:
    """Rows and percentage per label."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "percent", 100.0 * F.col("rows") / total)


def feature_summary(df: DataFrame, *, features=NUMERIC_FEATURES, places: int | None = 2) -> DataFrame:
    """Mean and sample deviation per label, one row per feature, largest difference first.

    One aggregate pass; the transposition works on the two aggregated rows. ``places``
    rounds the output, null leaves it as it is.
    """
    wide = df.groupBy("label").agg(*[
        F.struct(F.avg(f).alias("m"), F.stddev_samp(f).alias("s")).alias(f) for f in features
    ])
    tall = wide.select("label", F.explode(F.array(*[
        F.struct(F.lit(f).alias("features"), F.col(f)["m"].alias("m"), F.col(f)["s"].alias("s"))
        for f in features
    ])).alias("_x")).select("label", "_x.*")

    def of(label, column):
        return F.max(F.when(F.col("label") == label, F.col(column)))

    table = tall.groupBy("features").agg(
        of(0, "m").alias("human_mean"), of(1, "m").alias("ai_mean"),
        of(0, "s").alias("human_std"), of(1, "s").alias("ai_std"),
    ).withColumn("diff", F.col("ai_mean") - F.col("human_mean"))
    if places is not None:
        table = table.withColumns({c: F.bround(c, places) for c in table.columns if c != "features"})
    return table.withColumn("abs_diff", F.abs("diff")).orderBy(F.desc("abs_diff"), "features")


def quantile_caps(df: DataFrame, *, features=NUMERIC_FEATURES, q: float = 0.99) -> DataFrame:
    """``feature, upper``: the exact quantile over all rows."""
    return exact_quantiles(
        long_features(df, features), by=["feature"], value="value", probabilities={"upper": q})


def counted_values(df: DataFrame, *, features=NUMERIC_FEATURES, q: float = 0.99) -> DataFrame:
    """``label, feature, value, c``: how often each value up to its feature's cap occurs.

    The table is read once; caps and whatever follows come from its counts.
    """
    counted = cut_lineage(long_features(df, features, keep=["label"]).where("value is not null").groupBy(
        "label", "feature", "value").agg(F.count(F.lit(1)).alias("c")))
    caps = exact_quantiles(counted, by=["feature"], value="value", probabilities={"upper": q}, weight="c")
    upper = caps.agg(F.map_from_entries(F.collect_list(F.struct("feature", "upper")))).scalar()
    return counted.where(F.col("value") <= F.try_element_at(upper, F.col("feature")))


def capped_values(df: DataFrame, *, features=NUMERIC_FEATURES, q: float = 0.99) -> DataFrame:
    """``label, feature, value`` without the values above each feature's cap."""
    caps = quantile_caps(df, features=features, q=q).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "upper")))).scalar()
    return long_features(df, features, keep=["label"]).where(
        F.col("value") <= F.try_element_at(caps, F.col("feature")))


def density_histogram(df: DataFrame, *, features=HISTOGRAM_FEATURES, bins: int = 40,
                      q: float = 0.99) -> DataFrame:
    """Equal-width density histogram per feature and label, after capping.

    The last bin is closed; a constant column gets a range of one around its value.
    """
    counted = counted_values(df, features=features, q=q)
    spans = counted.groupBy("feature", "label").agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.sum("c").alias("_n"))
    flat = F.col("_lo") == F.col("_hi")
    spans = spans.select(
        "feature", "label", "_n",
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"),
    )
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        counted.join(spans, ["feature", "label"])
        .withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy("feature", "label", "bin")
        .agg(F.sum("c").alias("rows"), F.first("_n").alias("_n"), F.first("lo").alias("lo"),
             F.first("hi").alias("hi"))
        .select("feature", "label", "bin", "rows",
                (F.col("lo") + F.col("bin") * width).alias("bin_start"),
                (F.col("rows") / (F.col("_n") * width)).alias("density"))
    )


def _gram_sums(df: DataFrame, features) -> DataFrame:
    """One row a task: a shift, and for all ordered pairs of features the rows with both values, the
    sums of the first and of the product over them, relative to the shift."""
    d = len(features)

    def sums(batches):
        shift, parts = None, None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            known = ~np.isnan(x)
            if shift is None and len(x):
                # A value of the column itself, so that a constant leaves exact zeros.
                shift = np.where(known.any(axis=0), x[known.argmax(axis=0), np.arange(d)], 0.0)
                parts = [np.zeros((d, d)) for _ in range(3)]
            if len(x):
                u, here = np.where(known, x - shift, 0.0), known.astype(float)
                for total, more in zip(parts, (here.T @ here, u.T @ here, u.T @ u)):
                    total += more
        if shift is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(v.ravel())], pa.list_(pa.float64())) for v in (shift, *parts)], names=["shift", "n", "sx", "sxy"])

    return df.select(*[F.col(f).cast("double").alias(f) for f in features]).mapInArrow(
        sums, "shift array<double>, n array<double>, sx array<double>, sxy array<double>")


def correlation_matrix(df: DataFrame, *, features=NUMERIC_FEATURES, places: int = 2) -> DataFrame:
    """``feature_a, feature_b, r`` for all ordered pairs, from one pass of matrix products.

    Each task adds up its Gram matrix around values of its own; the tasks' sums are moved to one
    shift and added by pair. Missing values leave a row out of their pairs only. Constant
    columns have no correlation (null), also with themselves.
    """
    d = len(features)
    parts = cut_lineage(_gram_sums(df, features))
    place = F.explode(F.sequence(F.lit(0), F.lit(d * d - 1)))
    at = parts.select("*", place.alias("k")).withColumns({"i": F.expr(f"k div {d}").cast("int"), "j": (F.col("k") % d).cast("int")})
    flipped = F.col("j") * d + F.col("i")
    entries = at.select(
        "i", "j", F.col("n")[F.col("k")].alias("n"), F.col("sx")[F.col("k")].alias("si"), F.col("sx")[flipped].alias("sj"),
        F.col("sxy")[F.col("k")].alias("sij"), F.col("shift")[F.col("i")].alias("ci"), F.col("shift")[F.col("j")].alias("cj"))
    lookup = entries.where("i = j").groupBy("i").agg(F.min("ci").alias("c")).agg(
        F.map_from_entries(F.collect_list(F.struct("i", "c")))).scalar()
    di, dj = (F.col(c) - F.try_element_at(lookup, F.col(i)) for c, i in (("ci", "i"), ("cj", "j")))
    sums = entries.withColumns({"di": di, "dj": dj}).groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum(F.col("si") + F.col("n") * F.col("di")).alias("si"),
        F.sum(F.col("sj") + F.col("n") * F.col("dj")).alias("sj"),
        F.sum(F.col("sij") + F.col("di") * F.col("sj") + F.col("dj") * F.col("si") + F.col("n") * F.col("di") * F.col("dj")).alias("sij"))
    covariance = F.try_divide(F.col("sij"), F.col("n")) - F.try_divide(F.col("si"), F.col("n")) * F.try_divide(F.col("sj"), F.col("n"))
    table = sums.select("i", "j", covariance.alias("c"))
    spread = table.where("i = j").select("i", F.when(F.col("c") > 0, F.sqrt("c")).alias("s"))
    deviations = spread.agg(F.map_from_entries(F.collect_list(F.struct("i", "s")))).scalar()
    si, sj = (F.try_element_at(deviations, F.col(c)) for c in ("i", "j"))
    names = F.array(*[F.lit(f) for f in features])
    r = F.when(F.col("i") == F.col("j"), F.when(si > 0, F.lit(1.0))).otherwise(
        F.round(F.try_divide(F.col("c"), si * sj), places))
    return table.select(names[F.col("i")].alias("feature_a"), names[F.col("j")].alias("feature_b"), r.alias("r"))


def box_statistics(df: DataFrame, *, features=NUMERIC_FEATURES, q: float = 0.99) -> DataFrame:
    """Quartiles, median and whiskers per feature and label after capping.

    A whisker ends at the furthest value within 1.5 interquartile ranges of the box.
    """
    counted = counted_values(df, features=features, q=q)
    quartiles = exact_quantiles(
        counted, by=["feature", "label"], value="value", weight="c",
        probabilities={"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col("value")
    return (
        counted.join(quartiles, ["feature", "label"])
        .groupBy("feature", "label", "q1", "median", "q3")
        .agg(
            F.least(F.min(F.when(v >= F.col("q1") - reach, v)), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(v <= F.col("q3") + reach, v)), F.col("q3")).alias("whisker_high"),
            F.sum("c").alias("rows"),
        )
    )


def length_summary(df: DataFrame, *, column: str = "char_count") -> DataFrame:
    """One row: minimum, median, mean, maximum."""
    median = exact_quantiles(df.select(column), by=[], value=column,
                             probabilities={"median": 0.5}).scalar()
    return df.agg(
        F.min(column).alias("min"), F.avg(column).alias("mean"), F.max(column).alias("max")
    ).withColumn("median", median)


def request_summary(log: DataFrame, *, mode: str, status: str, elapsed: str, statuses) -> DataFrame:
    """Requests, counts per status and mean, median and maximum time per mode."""
    base = log.groupBy(mode).agg(
        F.count(F.lit(1)).alias("total_requests"),
        *[F.count_if(F.col(status) == s).alias(f"status_{s}") for s in statuses],
        F.avg(elapsed).alias("mean_response"), F.max(elapsed).alias("maximum_response"),
    )
    medians = exact_quantiles(log, by=[mode], value=elapsed, probabilities={"median_response": 0.5})
    return base.join(medians, mode)


def group_summary(df: DataFrame, *, groups=("source", "label"), subtotals: bool = False) -> DataFrame:
    """Rows and distinct documents per group; ``subtotals`` adds rolled-up rows."""
    per_document = df.groupBy(*groups, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    if not subtotals:
        return per_document.groupBy(*groups).agg(
            F.sum("n").alias("rows"), F.count(F.lit(1)).alias("documents"))
    return per_document.rollup(*groups).agg(
        F.sum("n").alias("rows"), F.countDistinct("doc_id").alias("documents"))
