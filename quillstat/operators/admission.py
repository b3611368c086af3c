"""Sliding-window admission per client, as a batch job."""

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.state import cut_lineage, spread_by
from .running import running_total


def quiet_sessions(events: DataFrame, *, key: str, time_us: str, order: list[str],
                   window_us: int) -> DataFrame:
    """Number the stretches of each key that no window spans (``session``).

    After a pause of at least one window every remembered admission has expired, so
    stretches are independent and a busy client is spread over many tasks. Both the
    previous event and the stretch number are found through time spans, not with one
    window over a whole client.
    """
    span = F.floor(F.col(time_us) / (64 * window_us))
    cut = events.withColumn("_span", span)
    last = cut.groupBy(key, "_span").agg(F.max(time_us).alias("_last"))
    earlier = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = last.select(key, "_span", F.max("_last").over(earlier).alias("_before"))
    inside = Window.partitionBy(key, "_span").orderBy(time_us, *order)
    previous = F.coalesce(F.lag(time_us).over(inside), F.col("_before"))
    pauses = (
        cut.join(before, [key, "_span"])
        .withColumn("_previous", previous)
        .withColumn("_starts", (
            F.col("_previous").isNull() | (F.col(time_us) - F.col("_previous") >= window_us)
        ).cast("long"))
        .select(*events.columns, "_starts")
    )
    return running_total(
        pauses, keys=[key], bucket=span, order=[time_us, *order], value=F.col("_starts"),
        out="session",
    ).drop("_starts")


class _Recent:
    """The remembered admissions of one client, oldest first."""

    def __init__(self, limit: int, window_us: int, start=()):
        self.limit, self.window_us, self.times = limit, window_us, deque(start)

    def judge(self, now: int) -> bool:
        while self.times and self.times[0] <= now - self.window_us:
            self.times.popleft()
        if len(self.times) >= self.limit:
            return False
        self.times.append(now)
        return True


def _in_time_order(rows: DataFrame, starts: DataFrame, unit: list[str], order: list[str]) -> DataFrame:
    """``rows`` of each unit in time order behind a row that only has the ``_start`` the unit begins with."""
    marked = rows.withColumn("_start", F.lit(None).cast("array<long>"))
    first = starts.where(F.size("_start") > 0).select(*unit, "_start")
    # The row of the start has no time, so it sorts first.
    return spread_by(marked.unionByName(first, allowMissingColumns=True), *unit).sortWithinPartitions(
        *unit, "_us", *order)


def _ends(rows: DataFrame, starts: DataFrame, unit: list[str], limit: int, window_us: int) -> DataFrame:
    """``unit, _end``: the admissions a unit leaves behind, from the start given for it."""
    fields = [rows.schema[c] for c in unit] + [T.StructField("_end", T.ArrayType(T.LongType()))]

    def scan(batches):
        current, state, out = None, None, []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in (*unit, "_us", "_start")]
            for *own, now, start in zip(*columns):
                if own != current:
                    if current is not None:
                        out.append((*current, list(state.times)))
                    current, state = own, _Recent(limit, window_us, start or ())
                if now is not None:
                    state.judge(now)
            if len(out) > 10_000:
                yield table(out)
                out = []
        if current is not None:
            out.append((*current, list(state.times)))
        yield table(out)

    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def table(out):
        return pa.RecordBatch.from_pylist([dict(zip(arrow.names, row)) for row in out], schema=arrow)

    return _in_time_order(rows.select(*unit, "_us"), starts, unit, []).mapInArrow(scan, schema)


def span_starts(rows: DataFrame, *, key: str, limit: int, window_us: int, rounds: int) -> DataFrame | None:
    """``key, session, _part, _unit, _start`` for the spans of sessions of several spans; None if none has.

    All spans are solved at once from an empty start. Those whose predecessor leaves something
    else than was assumed are solved again, until nothing moves: histories from different starts
    soon admit the same request and agree from there on. A session that still moves after
    ``rounds`` (requests at an even beat never agree) is one ``_unit`` from its first open span on.
    """
    unit = [key, "session", "_part"]
    spans = rows.groupBy(*unit).agg(F.min("_us").alias("_first"))
    several = spans.groupBy(key, "session").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    several = cut_lineage(several)
    if several.isEmpty():
        return None
    narrow = cut_lineage(rows.select(*unit, "_us").join(several, [key, "session"]))
    spans = spans.join(several, [key, "session"]).withColumn("_start", F.array().cast("array<long>"))
    known = cut_lineage(spans.join(_ends(narrow, spans, unit, limit, window_us), unit))
    before = Window.partitionBy(key, "session").orderBy("_part")
    alive = F.filter(F.lag("_end").over(before), lambda us: us > F.col("_first") - window_us)
    for number in range(rounds + 1):
        due = cut_lineage(known.withColumn("_due", F.coalesce(alive, F.array().cast("array<long>"))))
        moved = F.col("_due") != F.col("_start")
        again = due.where(moved).select(*unit, "_first", F.col("_due").alias("_start"))
        if number == rounds or again.isEmpty():
            break
        solved = again.join(_ends(narrow.join(again.select(*unit), unit), again, unit, limit, window_us), unit)
        known = cut_lineage(due.where(~moved).select(*known.columns).unionByName(solved.select(*known.columns)))
    first_open = F.min(F.when(moved, F.col("_part"))).over(Window.partitionBy(key, "session"))
    return due.select(*unit, F.least("_part", first_open).alias("_unit"), F.col("_due").alias("_start"))


def admit_requests(events: DataFrame, *, key: str, time: str, order: list[str], limit: int = 60,
                   window_seconds: int = 60, span_windows: int = 1024, rounds: int = 8) -> DataFrame:
    """Add ``admitted``: fewer than ``limit`` earlier admissions in the last window.

    Denied requests are not remembered; an admission exactly one window old has expired.
    Rows travel whole and are never joined back, so equal rows stay as many as they are. Each
    stretch is sorted by Spark and streamed through a deque of at most ``limit`` times,
    whatever its length. A client that never pauses is cut into spans of ``span_windows`` windows,
    which are solved side by side (``span_starts``).
    """
    window_us = window_seconds * 1_000_000
    # A request without a client counts as one of a client of its own kind.
    client = F.when(F.col(key).isNull(), "").otherwise(F.concat(F.lit("="), F.col(key).cast("string")))
    stamped = events.withColumns({"_us": F.unix_micros(F.col(time).cast("timestamp")), "_client": client})
    sessions = cut_lineage(quiet_sessions(stamped, key="_client", time_us="_us", order=order, window_us=window_us).withColumn(
        "_part", F.floor(F.col("_us") / (span_windows * window_us)).cast("long")))
    starts = span_starts(sessions, key="_client", limit=limit, window_us=window_us, rounds=rounds)
    unit = ["_client", "session", "_unit"]
    if starts is None:
        rows = sessions.withColumns({"_unit": F.col("_part"), "_start": F.lit(None).cast("array<long>")})
        ordered = spread_by(rows, "_client", "session").sortWithinPartitions("_client", "session", "_us", *order)
    else:
        rows = sessions.join(starts.select("_client", "session", "_part", "_unit"), ["_client", "session", "_part"], "left")
        ordered = _in_time_order(rows, starts.where("_part = _unit"), unit, order)
    schema = T.StructType([*events.schema.fields, T.StructField("admitted", T.BooleanType())])
    names = events.columns

    def scan(batches):
        current, state = None, None
        for batch in batches:
            place = {n: k for k, n in enumerate(batch.schema.names)}
            flags = []
            for *own, now, start in zip(*(batch.column(place[n]).to_pylist() for n in (*unit, "_us", "_start"))):
                if own != current:
                    current, state = own, _Recent(limit, window_us, start or ())
                flags.append(None if start is not None else state.judge(now))
            made = pa.RecordBatch.from_arrays(
                [*(batch.column(place[n]) for n in names), pa.array(flags, pa.bool_())], names=[*names, "admitted"])
            yield made.filter(pa.array([f is not None for f in flags], pa.bool_()))

    return ordered.mapInArrow(scan, schema)
