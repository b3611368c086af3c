"""Mixing sources to target weights by the cube method.

Each source has a target of words; a document of it is taken ``target / words of the source`` times
on average. The whole part is certain; the fraction is an inclusion probability. Blocks of a source
move their probabilities along vectors that keep the expected number of documents and of words
(flight), until at most two of a block are undecided; those of all blocks form the blocks of the
next round. When a source is down to one block, its last documents take the outcome that misses the
words least (landing), together with a few held back for it.
"""

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, query, table, written

WEIGHTS, TOTAL_PERCENT, MOST_TIMES = (3, 1, 2), 150, 2
#: Documents that one flight decides at a time.
BLOCK = 2000
#: Documents held back for the landing of a source, which tries all outcomes of these and two more.
HELD = 12


def source_ranks(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``, from 0 by code point, null last, without one task for all."""
    order = [F.col("source").isNull(), F.col("source")]
    local = written(sources.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "sources")
    parts = local.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("part", (before - F.col("first")).alias("shift"))
    return local.join(offsets, "part").select(*sources.columns, (F.col("at") + F.col("shift")).alias("rank"))


def targets(sources: DataFrame, *, weights=WEIGHTS, percent: int = TOTAL_PERCENT, most: int = MOST_TIMES) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: shares by weight, repeated in order of the
    sources, of ``percent`` of all words; none above ``most`` times its words, excess reshared."""
    ranked = written(source_ranks(sources).withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))), "ranks")
    whole = (ranked.agg(F.sum("source_size")).first()[0] or 0) * percent / 100
    level, cap = None, most * F.col("source_size")
    while True:
        over = F.lit(False) if level is None else cap <= level * F.col("weight")
        fixed, free = ranked.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        new = (whole - (fixed or 0)) / free if free else None
        if new is None or new == level:
            break
        level = new
    share = F.lit(0.0) if level is None else F.least(F.lit(float(level)) * F.col("weight"), cap.cast("double"))
    return ranked.withColumn("target", share).drop("rank", "weight")


def flight(chances: list[float], sizes: list[int], draw: random.Random) -> list[float]:
    """Chances moved until at most two are neither 0 nor 1, keeping their sum and that of words."""
    out, active = list(chances), []
    for i in range(len(out)):
        if not 0 < out[i] < 1:
            continue
        active.append(i)
        if len(active) < 3:
            continue
        a, b, c = active
        way = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
        if not any(way):
            way = (1, -1, 0)
        up = min((1 - out[i]) / w if w > 0 else out[i] / -w for i, w in zip(active, way) if w)
        down = min(out[i] / w if w > 0 else (1 - out[i]) / -w for i, w in zip(active, way) if w)
        step = up if draw.random() * (up + down) < down else -down
        for i_, w in zip(active, way):
            moved = out[i_] + step * w
            out[i_] = 0.0 if moved < 1e-9 else 1.0 if moved > 1 - 1e-9 else moved
        active = [i_ for i_ in active if 0 < out[i_] < 1]
    return out


def held_back(chances: list[float], sizes: list[int], number: int = HELD) -> set[int]:
    """Undecided documents around the middle size that the landing decides together with the last
    two: their sums are dense enough to meet the words almost exactly."""
    open_ = sorted((i for i, p in enumerate(chances) if 0 < p < 1), key=lambda i: sizes[i])
    start = max(0, (len(open_) - number) // 2)
    return set(open_[start:start + number])


def land(chances: list[float], sizes: list[int]) -> list[float]:
    """The outcome of the undecided few that misses the expected words least, then the documents."""
    few = [i for i, p in enumerate(chances) if 0 < p < 1]
    if not few:
        return list(chances)
    ways = (np.arange(1 << len(few))[:, None] >> np.arange(len(few))) & 1
    p, x = np.array([chances[i] for i in few]), np.array([sizes[i] for i in few], dtype=float)
    words_, docs_ = np.abs(ways @ x - p @ x), np.abs(ways.sum(axis=1) - p.sum())
    best = ways[np.lexsort((docs_, words_))[0]]
    out = list(chances)
    for i, w in zip(few, best.tolist()):
        out[i] = float(w)
    return out


def _fly(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([("size", "descending"), ("draw", "ascending"), ("doc_id", "ascending")])
    chances, sizes = rows["chance"].to_pylist(), rows["size"].to_pylist()
    seed = hashlib.sha256(repr((rows["draw"].to_pylist()[:64], len(rows))).encode()).digest()
    last = rows["blocks"][0].as_py() == 1
    back = held_back(chances, sizes) if last else set()
    out = flight([2.0 if i in back else p for i, p in enumerate(chances)], sizes, random.Random(seed))
    out = [p if i in back else q for i, (p, q) in enumerate(zip(chances, out))]
    return rows.set_column(rows.schema.get_field_index("chance"), "chance",
                           pa.array(land(out, sizes) if last else out, pa.float64()))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{BLANKS}]+")).cast("long")


def mix(docs: DataFrame, *, weights=WEIGHTS, percent: int = TOTAL_PERCENT, most: int = MOST_TIMES) -> DataFrame:
    """``doc_id, th, size, source_size, target, taken`` for every row of ``docs`` (doc_id, source, text).

    ``th`` is a hash of the text. A document without words is taken 0 words; so is a source without
    any. Null source is a source, the last. Rows that agree in all of id, text and source share the
    draw's key and are decided one by one. Results depend on the rows only, not on their places,
    except which of several rows without id but with equal text is taken. An empty table gives none.
    """
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64("text").alias("th"), word_count(F.col("text")).alias("size"),
    ).withColumn("draw", F.xxhash64("doc_id", "th", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = targets(sources, weights=weights, percent=percent, most=most).withColumnRenamed("source", "of")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "th", "draw", "size", "source_size", "target", F.floor(times).cast("long").alias("whole"),
        (times - F.floor(times)).alias("chance"), F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))
    rows = written(rows, "chances")
    undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
    done, rows = [rows.filter(~undecided)], rows.filter(undecided)
    turn = 0
    while turn == 0 or not rows.isEmpty():
        keyed = rows.withColumn("block", F.pmod(F.xxhash64("draw", F.lit(turn)), F.col("blocks")))
        flown = keyed.groupBy("source", "block").applyInArrow(_fly, keyed.schema).drop("block")
        flown = written(flown, "flight").withColumn("blocks", F.ceil(2 * F.col("blocks") / BLOCK).cast("long"))
        done.append(flown.filter(~undecided))
        rows = flown.filter(undecided)
        turn += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "th", "size", "source_size", "target",
                      (F.col("size") * (F.col("whole") + F.col("chance").cast("long"))).alias("taken"),
                      (F.col("whole") + F.col("chance").cast("long")).alias("copies"))


@query("op4_cube_mix")
def op4(spark, folder):
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")
