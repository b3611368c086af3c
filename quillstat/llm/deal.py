"""Which hashed features occur in more than one item of the whole corpus.

Texts are dealt into groups of a few MB by a hash. Each group sends the distinct features of its
items, as packed 24-bit fingerprints, to buckets by the leading bits of the hash; each bucket
counts in how many groups a feature occurs and answers every group in the order it asked, one
byte a feature. A feature of a third of all rows thus costs one entry a group, and no list of
rows of a key is ever gathered. Equal features have equal fingerprints, so a feature called
unique is unique; a few per cent of the unique ones are called repeated, which costs work, not
results.

A group computes its features twice, once to ask and once with the answers; both read the same
shuffled texts. Rows of a group are put into an order of their content, since a shuffle has none.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

_ASK = "gid int, bucket int, prints binary, many binary"
_PRINT = np.uint64((1 << 24) - 1)
_STEP = 65535
_ANSWER = "gid int, bucket int, counts binary"
#: Groups and buckets for each shuffle partition, so that hashing evens out; every group may send a
#: message to every bucket, as in a shuffle.
PER_PARTITION = 2


def grouped(docs: DataFrame) -> DataFrame:
    """``gid, doc_id, th, text`` of whole documents; ``th`` orders equal ids."""
    parts = buckets(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text",
    ).select(F.pmod(F.xxhash64("doc_id", "th"), F.lit(parts)).cast("int").alias("gid"), "doc_id", "th", "text")


def buckets(spark) -> int:
    return PER_PARTITION * partitions(spark)


def in_order(rows: pa.Table) -> pa.Table:
    return rows.sort_by([("doc_id", "ascending"), ("th", "ascending")])


def buckets_of(hashes: np.ndarray, number: int) -> np.ndarray:
    """Bucket by the leading bits; rises with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(number) >> np.uint64(32)).astype(np.int64)


def ask(groups: DataFrame, features: Callable[..., tuple[np.ndarray, np.ndarray]], given: DataFrame | None = None) -> DataFrame:
    """Answers ``gid, bucket, counts`` for ``features(rows) -> (sorted distinct hashes, in several items?)``.

    With ``given``, a table with a gid, its rows of the group are the second argument of ``features``.
    """
    number = buckets(groups.sparkSession)

    def prints(rows: pa.Table, *more: pa.Table) -> pa.Table:
        gid = (rows if len(rows) else more[0])["gid"][0].as_py()
        hashes, many = features(in_order(rows), *more)
        order = _print_order(hashes, number)
        hashes, many = hashes[order], many[order]
        bounds = np.searchsorted(buckets_of(hashes, number), np.arange(number + 1))
        low = (hashes & _PRINT).astype(np.int64)
        used = np.flatnonzero(np.diff(bounds))
        return pa.table({
            "gid": pa.array(np.full(len(used), gid, np.int32)), "bucket": pa.array(used.astype(np.int32)),
            "prints": pa.array([_packed(low[bounds[b]:bounds[b + 1]]) for b in used], pa.binary()),
            "many": pa.array([np.packbits(many[bounds[b]:bounds[b + 1]]).tobytes() for b in used], pa.binary()),
        })

    def count(rows: pa.Table) -> pa.Table:
        asked = [_unpacked(x) for x in rows["prints"].to_pylist()]
        many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(a)) for x, a in zip(rows["many"].to_pylist(), asked)]
        ends = np.cumsum([len(a) for a in asked])
        all_ = np.concatenate(asked)
        del asked
        # Memory follows the entries; they are sorted runs already, which a stable sort merges.
        order = np.argsort(all_, kind="stable")
        starts = np.flatnonzero(np.diff(all_[order], prepend=-1))
        weights = 1 + np.concatenate(many)[order]
        seen = np.minimum(np.add.reduceat(weights, starts, dtype=np.int64), 255).astype(np.uint8) if len(all_) else weights
        counts = np.empty(len(all_), np.uint8)
        counts[order] = np.repeat(seen, np.diff(starts, append=len(all_)))
        return pa.table({"gid": rows["gid"], "bucket": rows["bucket"],
                         "counts": pa.array([p.tobytes() for p in np.split(counts, ends[:-1])], pa.binary())})

    if given is None:
        asked = groups.groupBy("gid").applyInArrow(lambda rows: prints(rows), _ASK)
    else:
        asked = groups.groupBy("gid").cogroup(given.groupBy("gid")).applyInArrow(lambda rows, more: prints(rows, more), _ASK)
    return asked.groupBy("bucket").applyInArrow(count, _ANSWER)


def _print_order(hashes: np.ndarray, number: int) -> np.ndarray:
    """Order of the questions: by bucket, then fingerprint; equal ones as in ``hashes``."""
    return np.argsort((buckets_of(hashes, number) << 24) | (hashes & _PRINT).astype(np.int64), kind="stable")


def _packed(prints: np.ndarray) -> bytes:
    """Rising numbers as 16-bit steps; a step of 65535 goes on with the next."""
    steps = np.diff(prints, prepend=0)
    if (steps < _STEP).all():
        return steps.astype(np.uint16).tobytes()
    more, rest = steps // _STEP, steps % _STEP
    out = np.full(len(steps) + int(more.sum()), _STEP, np.uint16)
    out[np.cumsum(more + 1) - 1] = rest
    return out.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint16)
    return np.cumsum(steps, dtype=np.int32)[steps != _STEP]


def answered(answers: pa.Table, hashes: np.ndarray, number: int) -> np.ndarray:
    """The counts of a group's sorted distinct hashes."""
    rows = answers.sort_by("bucket")["counts"].to_pylist()
    out = np.empty(len(hashes), np.uint8)
    out[_print_order(hashes, number)] = np.frombuffer(b"".join(rows), np.uint8)
    return out


def ids_of(rows: pa.Table) -> np.ndarray:
    """doc_id as numbers; null is the largest, so that it precedes nothing."""
    return pc.fill_null(rows["doc_id"], np.iinfo(np.int64).max).to_numpy()
