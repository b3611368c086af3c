"""Clustering of one class of a stored feature table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import CLUSTER_FEATURES
from ..functions.state import cut_lineage
from ..operators import cluster
from ..operators.running import dense_index
from ..operators.split import examples_per_group, sample_rows
from ..sources import readers, sinks


def cluster_class(spark: SparkSession, path: str, output: str, *, method: str = "kmeans", label: int = 1,
                  keys=("doc_id", "sent_id"), features=CLUSTER_FEATURES, k: int = 5, eps: float = 1.0,
                  min_samples: int = 16, sample: int | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """Write assignments, sizes, profile, examples, projection and silhouettes under ``output``.

    ``keys`` identify and order the rows. Density clustering may take a seeded ``sample`` of the
    class; profiles compare clusters with the whole class. Silhouettes are means with and
    without noise, over at most 20,000 rows as published.
    """
    if method not in {"kmeans", "density"}:
        raise ValueError(f"method {method!r}: clusters are found by kmeans or density")
    keys = list(keys)
    stored = readers.feature_table(spark, path).where(F.col("label").try_cast("double") == label)
    numbers = stored.select(*keys, "text", *[F.col(c).try_cast("double").alias(c) for c in features])
    rows = cut_lineage(dense_index(cut_lineage(numbers), order=keys, out="pid"))
    points = cluster.class_points(rows, id_col="pid", features=features, label=None)
    points = cut_lineage(points if sample is None else sample_rows(points, n=sample, keys=["pid"], seed=seed))
    found = (cluster.dbscan(points, eps=eps, min_samples=min_samples) if method == "density"
             else cluster.kmeans_assign(points, cluster.kmeans_fit(points, k=k, seed=seed)))
    assigned = cut_lineage(found.select("pid", "cluster"))
    members, placed = rows.join(assigned, "pid"), points.join(assigned, "pid")

    def mean(chosen: DataFrame, name: str) -> DataFrame:
        return cluster.silhouette(chosen, sample=20_000, seed=seed).agg(F.avg("silhouette").alias("silhouette")).select(
            F.lit(name).alias("points"), "silhouette")

    results = {
        "assignments": members.select(*keys, "cluster"),
        "sizes": cluster.cluster_sizes(assigned),
        "profile": cluster.cluster_profile(members, rows, features=features),
        "examples": examples_per_group(members.select(*keys, "pid", "cluster", "text"), group="cluster",
                                       keys=["pid"], seed=seed).drop("pid"),
        "projection": cluster.pca2(points).join(assigned, "pid"),
        "silhouettes": mean(placed, "all").unionByName(mean(placed.where("cluster <> -1"), "without noise")),
    }
    for name, frame in results.items():
        sinks.write_table(frame, f"{output}/{name}")
    return {name: spark.read.parquet(f"{output}/{name}") for name in results}
