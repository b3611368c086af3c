"""Imputing and scaling with population statistics, as one aggregate and a projection."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import exact_quantiles


def moments(df: DataFrame, columns) -> DataFrame:
    """One row: ``<column>_mean``, ``<column>_std`` (population, zero becomes one)."""
    return df.agg(*[
        e for c in columns for e in (
            F.avg(c).alias(f"{c}_mean"),
            F.when(F.stddev_pop(c) == 0, 1.0).otherwise(F.stddev_pop(c)).alias(f"{c}_std"),
        )
    ])


def _row(stats: DataFrame):
    """The single row of ``stats`` as a scalar subquery: no join, no driver round trip."""
    return stats.select(F.struct(*stats.columns)).scalar()


def scale(df: DataFrame, columns, *, stats: DataFrame | None = None, centre: bool = False) -> DataFrame:
    """Divide by the population standard deviation; with ``centre``, subtract the mean."""
    row = _row(stats if stats is not None else moments(df, columns))
    shift = {c: (F.col(c) - row[f"{c}_mean"]) if centre else F.col(c) for c in columns}
    return df.withColumns({c: shift[c] / row[f"{c}_std"] for c in columns})


def standardise(df: DataFrame, columns, *, stats: DataFrame | None = None) -> DataFrame:
    return scale(df, columns, stats=stats, centre=True)


def long_features(df: DataFrame, columns, *, keep=()) -> DataFrame:
    """``keep..., feature, value`` with one row per feature."""
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in columns
    ])).alias("_f")).select(*keep, "_f.feature", "_f.value")


def medians(df: DataFrame, columns) -> DataFrame:
    """``feature, median`` (exact); one row per column."""
    return exact_quantiles(
        long_features(df, columns), by=["feature"], value="value", probabilities={"median": 0.5}
    )


def impute_median(df: DataFrame, columns, *, fitted: DataFrame | None = None) -> DataFrame:
    """Replace nulls by the column's median, fitted on ``fitted`` or on ``df`` itself."""
    table = fitted if fitted is not None else medians(df, columns)
    lookup = table.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median")))).scalar()
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.try_element_at(lookup, F.lit(c))) for c in columns
    })
