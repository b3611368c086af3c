"""All exploratory tables of a stored feature table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import HISTOGRAM_FEATURES, NUMERIC_FEATURES
from ..operators import explore
from ..sources import readers, sinks


def explore_features(spark: SparkSession, path: str, output: str, *, features=NUMERIC_FEATURES,
                     histogram=HISTOGRAM_FEATURES) -> dict[str, DataFrame]:
    """Write one table per analysis under ``output`` and return them by name.

    ``path`` holds labelled features; numbers may be stored as text. Lengths are summarised
    where the table has ``char_count``.
    """
    stored = readers.feature_table(spark, path)
    numbers = {c: F.col(c).try_cast("double") for c in stored.columns if c in {*features, *histogram}}
    table = stored.withColumns({**numbers, "label": F.col("label").try_cast("double").cast("int")})
    analyses = {
        "class_balance": explore.class_balance(table),
        "feature_summary": explore.feature_summary(table, features=features),
        "density_histogram": explore.density_histogram(table, features=histogram),
        "box_statistics": explore.box_statistics(table, features=features),
        "correlation": explore.correlation_matrix(table, features=features),
    }
    if "char_count" in stored.columns:
        analyses["length_summary"] = explore.length_summary(
            table.withColumn("char_count", F.col("char_count").try_cast("double")))
    for name, frame in analyses.items():
        sinks.write_table(frame, f"{output}/{name}")
    return {name: spark.read.parquet(f"{output}/{name}") for name in analyses}
