import random
from collections import deque
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quillstat.operators.admission import admit_requests
from quillstat.streaming.admission import admit_stream

START = datetime(2024, 1, 1)


def limiter(rows, limit, window):
    history, out = {}, {}
    for client, second, number in sorted(rows, key=lambda r: (r[1], r[2])):
        recent = history.setdefault(client, deque())
        while recent and recent[0] <= second - window:
            recent.popleft()
        out[number] = len(recent) < limit
        if out[number]:
            recent.append(second)
    return out


def table(spark, rows):
    return spark.createDataFrame(
        [(c, START + timedelta(seconds=s), n) for c, s, n in rows], "client string, at timestamp, n long")


def test_expiry_is_inclusive(spark):
    rows = [("a", 0, 0), ("a", 1, 1), ("a", 2, 2), ("a", 60, 3), ("a", 60, 4), ("a", 61, 5), ("b", 2, 6)]
    got = admit_requests(table(spark, rows), key="client", time="at", order=["n"], limit=2, window_seconds=60)
    assert {r.n: r.admitted for r in got.collect()} == {
        0: True, 1: True, 2: False, 3: True, 4: False, 5: True, 6: True}


def test_hot_client_and_pauses_against_a_plain_limiter(spark):
    rng = random.Random(6)
    rows = [("hot", rng.randrange(0, 4000) + 9000 * rng.randrange(3), n) for n in range(1500)]
    rows += [(f"c{rng.randrange(20)}", rng.randrange(0, 40_000), n) for n in range(1500, 2000)]
    want = limiter(rows, 3, 20)
    got = admit_requests(table(spark, rows).repartition(5), key="client", time="at", order=["n"],
                         limit=3, window_seconds=20)
    assert {r.n: r.admitted for r in got.collect()} == want
    assert not all(want.values())


def test_stream_equals_batch_over_several_micro_batches(spark, tmp_path):
    rng = random.Random(9)
    rows = sorted([(rng.choice("ab"), rng.randrange(0, 900), n) for n in range(120)], key=lambda r: r[1])
    for part in range(3):
        table(spark, rows[part * 40:(part + 1) * 40]).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))
    source = spark.readStream.schema(table(spark, rows).schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in"))
    decided = admit_stream(source, key="client", time="at", order=["n"], limit=2, window_seconds=30,
                           watermark="1 hour")
    decided.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).outputMode(
        "append").trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = {r.n: r.admitted for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == limiter(rows, 2, 30)
    assert spark.read.parquet(str(tmp_path / "out")).select(F.count("n")).first()[0] == 120


def test_equal_requests_stay_as_many(spark):
    rows = [("a", 0, 7), ("a", 0, 7), ("a", 0, 7)]
    got = admit_requests(table(spark, rows), key="client", time="at", order=["n"], limit=2, window_seconds=60).collect()
    assert len(got) == 3 and sum(r.admitted for r in got) == 2


def test_client_without_a_pause_in_spans(spark):
    """Random requests agree after a while; even ones never do and go through the last resort."""
    rng = random.Random(4)
    rows = [("busy", s, n) for n, s in enumerate(sorted(rng.randrange(0, 6000) for _ in range(4000)))]
    rows += [("even", 2 * n, 10_000 + n) for n in range(1500)] + [(None, 3 * n, 20_000 + n) for n in range(600)]
    rows += [(f"c{rng.randrange(5)}", rng.randrange(0, 40_000), 30_000 + n) for n in range(300)]
    events = table(spark, rows).withColumn("note", F.lit("kept")).repartition(5)
    for limit, span, rounds in ((3, 4, 8), (7, 16, 1), (1, 2, 0)):
        got = admit_requests(events, key="client", time="at", order=["n"], limit=limit, window_seconds=20,
                             span_windows=span, rounds=rounds).collect()
        assert {r.n: r.admitted for r in got} == limiter(rows, limit, 20)
        assert len(got) == len(rows) and {r.note for r in got} == {"kept"}


def test_spans_go_to_many_tasks(spark):
    rows = [("busy", n // 2, n) for n in range(8000)]
    out = admit_requests(table(spark, rows), key="client", time="at", order=["n"], limit=5, window_seconds=10, span_windows=20)
    shares = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(shares) > 1 and max(r["count"] for r in shares) < 8000
