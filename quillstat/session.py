"""Session helpers."""

import os
import tempfile
import zipfile
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

_SHIPPED = "quillstat.shipped"


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("quillstat")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    A cluster job started with ``--py-files`` does not need it.
    """
    context = spark.sparkContext
    if context.getLocalProperty(_SHIPPED):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quillstat-"), "quillstat.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(archive)
    context.setLocalProperty(_SHIPPED, "yes")


def side_by_side(jobs: list[Callable], *, parallelism: int = 4) -> list:
    """Results of independent fits whose Spark jobs share the cluster, in order."""
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        return pool.map(lambda job: job(), [inheritable_thread_target(j) for j in jobs])
