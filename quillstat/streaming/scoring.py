"""Streaming forms of scoring with quarantine, the session log and the monitor."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality
from ..operators.scoring import Scorer
from ..plans.scoring import score_checked
from ..sources.readers import spread


def score_stream(texts: DataFrame, *, sentence_scorer: Scorer, document_scorer: Scorer,
                 accepted_path: str, rejected_path: str, checkpoint: str, id_col: str = "doc_id",
                 trigger: dict | None = None, **limits) -> StreamingQuery:
    """Score a stream of texts with the batch code; two Parquet sinks by outcome.

    ``trigger`` has the keywords of ``DataStreamWriter.trigger``; by default what is there is
    scored and the query ends.

    Each micro-batch overwrites its own ``batch`` partition, so a batch replayed after a
    failure leaves no duplicates.
    """
    def handle(batch: DataFrame, number: int) -> None:
        # One file is one split: its texts are spread before any work, and checked once for both sinks.
        checked = quality.admit(spread(batch), **limits).persist()
        try:
            scored, rejected = score_checked(
                checked, sentence_scorer=sentence_scorer, document_scorer=document_scorer, id_col=id_col)
            for frame, path in ((rejected, rejected_path), (scored, accepted_path)):
                frame.write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            checked.unpersist()

    return (
        texts.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def outcome_windows(outcomes: DataFrame, *, time: str, code: str, value: str, width: str = "1 day",
                    watermark: str | None = None) -> DataFrame:
    """Counts and mean value per time window and outcome code.

    The same function serves a batch table and, with a ``watermark``, a stream whose late
    rows are dropped.
    """
    stamped = outcomes.withColumn(time, F.col(time).cast("timestamp"))
    if watermark:
        stamped = stamped.withWatermark(time, watermark)
    return (
        stamped.groupBy(F.window(time, width).alias("_w"), code)
        .agg(F.count(F.lit(1)).alias("requests"), F.avg(value).alias("mean_value"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                code, "requests", "mean_value")
    )


def upsert_windows(windows: DataFrame, *, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep a table of windows up to date while they are open; ``trigger`` as in ``score_stream``.

    ``windows`` is a stream of ``outcome_windows``. In update mode each micro-batch has the windows
    it changed. They are written as a partition of their own, overwritten when the micro-batch is
    replayed; ``latest_windows`` reads the newest row of each window.
    """
    def handle(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        windows.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def latest_windows(changes: DataFrame, *, code: str) -> DataFrame:
    """The state of each window and code after the last micro-batch that changed it."""
    kept = [c for c in changes.columns if c not in ("window_start", code, "batch")]
    return changes.groupBy("window_start", code).agg(
        F.max_by(F.struct(*kept), F.col("batch").cast("long")).alias("_w")).select(
        "window_start", code, *[F.col(f"_w.{c}").alias(c) for c in kept])


def append_session_log(entries: DataFrame, *, path: str, checkpoint: str,
                       trigger: dict | None = None) -> StreamingQuery:
    """Append scored checks to a table partitioned by day of arrival; ``trigger`` as in ``score_stream``."""
    return (
        entries.withColumn("day", F.current_date())
        .writeStream.outputMode("append").format("parquet").partitionBy("day")
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(path)
    )
