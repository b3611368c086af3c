"""Exact set-similarity join of lines: later lines that resemble an earlier one go.

A line is the set of its hashed shingles of five words; a line of fewer words can be one shingle of
them all, which only equal lines share. Equal lines meet first: each group of
documents sends one digest and place of each of its distinct lines and learns whether it holds the
earliest. ``deal`` then orders the shingles of the remaining, distinct lines by rarity. Linked lines
share a token of their prefixes (prefix filter), have similar sizes (length filter) and enough tokens
behind the shared one (positional filter); what passes is verified.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import deal
from .common import query, table, written
from .jaccard_join import digests, one_of_each, rarity_keys
from .shingles import shingle_sets, text_slices

WIDTH, PERCENT = 5, 75
#: Lines with one shared token that one task compares at a time; more are compared in pairs of blocks.
BLOCK_LINES = 4_000
_FIRST = "gid int, bucket int, digests binary, docs binary, hashes binary, twins binary, lines binary"
_FLAGS = "gid int, bucket int, counts binary"
_LINE = ("gid int, node binary, place struct<doc_id: long, th: long, twin: long, line: long>, "
         "rows array<int>, lines array<int>, tokens binary, prefix array<long>")
_PLACE = pa.struct([(k, pa.int64()) for k in ("doc_id", "th", "twin", "line")])


def line_sets(rows: pa.Table, width: int):
    """``(hashes, bounds, digests, row of each line, number of the line in it)``."""
    parts, sizes, owner, number = [], [], [], []
    for row, data, offsets in text_slices(rows["text"]):
        breaks = np.flatnonzero(data == 10)
        counts = np.diff(np.searchsorted(breaks, offsets)) + 1
        edges = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
        hashes, bounds = shingle_sets(data, np.append(edges, len(data)), width, short=True)
        parts.append(hashes)
        sizes.append(np.diff(bounds))
        owner.append(np.repeat(np.arange(row, row + len(counts)), counts))
        number.append(np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    if not parts:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, "V16"), none, none
    hashes, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    return hashes, bounds, digests(hashes, bounds), np.concatenate(owner), np.concatenate(number)


def twins(rows: pa.Table) -> np.ndarray:
    """Number of each row among those with its id and text; rows are in order."""
    ids, th = deal.ids_of(rows), rows["th"].to_numpy()
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (th[1:] != th[:-1])
    heads = np.flatnonzero(new)
    return np.arange(len(ids)) - np.repeat(heads, np.diff(np.append(heads, len(ids))))


def _distinct(digest: np.ndarray, sizes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """First line of each distinct set of a group, by bucket, and the buckets."""
    chosen = np.flatnonzero(one_of_each(digest, sizes))
    bucket = deal.buckets_of(digest[chosen].view(np.uint64)[::2], buckets)
    order = np.argsort(bucket, kind="stable")
    return chosen[order], bucket[order]


def earliest(groups: DataFrame, width: int) -> DataFrame:
    """``gid, bucket, counts``: 1 where a group holds the earliest of equal lines, in its own order."""
    buckets = deal.buckets(groups.sparkSession)

    def send(rows: pa.Table) -> pa.Table:
        rows = deal.in_order(rows)
        _, bounds, digest, owner, number = line_sets(rows, width)
        chosen, bucket = _distinct(digest, np.diff(bounds), buckets)
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(edges))
        at = owner[chosen]
        columns = (digest[chosen], deal.ids_of(rows)[at], rows["th"].to_numpy()[at],
                   twins(rows)[at].astype(np.int32), number[chosen].astype(np.int32))
        return pa.Table.from_arrays(
            [pa.array(np.full(len(used), rows["gid"][0].as_py(), np.int32)), pa.array(used.astype(np.int32)),
             *(pa.array([c[edges[b]:edges[b + 1]].tobytes() for b in used], pa.binary()) for c in columns)],
            names=["gid", "bucket", "digests", "docs", "hashes", "twins", "lines"])

    def decide(rows: pa.Table) -> pa.Table:
        digest, doc, th, twin, line = (np.frombuffer(b"".join(rows[n].to_pylist()), kind) for n, kind in (
            ("digests", np.uint64), ("docs", np.int64), ("hashes", np.int64), ("twins", np.int32), ("lines", np.int32)))
        order = np.lexsort((line, twin, th, doc, digest[1::2], digest[::2]))
        low, high = digest[::2][order], digest[1::2][order]
        first = np.ones(len(order), bool)
        first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        flags = np.zeros(len(order), np.uint8)
        flags[order] = first
        ends = np.cumsum([len(x) // 16 for x in rows["digests"].to_pylist()])
        return pa.table({"gid": rows["gid"], "bucket": rows["bucket"],
                         "counts": pa.array([p.tobytes() for p in np.split(flags, ends[:-1])], pa.binary())})

    return groups.groupBy("gid").applyInArrow(send, _FIRST).groupBy("bucket").applyInArrow(decide, _FLAGS)


def _firsts(digest: np.ndarray, sizes: np.ndarray, flags: pa.Table, buckets: int) -> np.ndarray:
    """True for lines that are the earliest of all equal ones."""
    chosen, _ = _distinct(digest, sizes, buckets)
    keep = np.zeros(len(digest), bool)
    keep[chosen] = np.frombuffer(b"".join(flags.sort_by("bucket")["counts"].to_pylist()), np.uint8) > 0
    return keep


def _several_tokens(sizes: np.ndarray, percent: int) -> np.ndarray:
    """False for lines of one shingle where only an equal line can resemble them."""
    return (sizes > 1) | (2 * percent <= 100)


def features(width: int, percent: int, buckets: int):
    def of(rows: pa.Table, flags: pa.Table):
        hashes, bounds, digest, _, _ = line_sets(rows, width)
        sizes = np.diff(bounds)
        keep = _firsts(digest, sizes, flags, buckets) & _several_tokens(sizes, percent)
        distinct, counts = np.unique(hashes[np.repeat(keep, sizes)], return_counts=True)
        return distinct, counts > 1
    return of


def candidate_lines(width: int, percent: int, buckets: int):
    """Earliest lines that may resemble others; a row without node has all lines that equal an earlier one."""
    def of(rows: pa.Table, answers: pa.Table) -> pa.Table:
        gid = (rows if len(rows) else answers)["gid"][0].as_py()
        rows = deal.in_order(rows)
        hashes, bounds, digest, owner, number = line_sets(rows, width)
        sizes = np.diff(bounds)
        kinds = answers["kind"].to_numpy()
        keep = _firsts(digest, sizes, answers.filter(pa.array(kinds == 0)), buckets)
        gone = np.flatnonzero(~keep & (sizes > 0))
        keep &= _several_tokens(sizes, percent)
        keys, several = rarity_keys(hashes, bounds, keep, answers.filter(pa.array(kinds == 1)), buckets)
        sums = np.concatenate([[0], np.cumsum(several)])
        keep &= 100 * (sums[bounds[1:]] - sums[bounds[:-1]]) >= percent * sizes
        out = np.flatnonzero(keep)
        tokens, prefix = [], []
        for i in out:
            ordered = np.sort(keys[bounds[i]:bounds[i + 1]])
            n = len(ordered)
            head = ordered[: n - -(-percent * n // 100) + 1]
            tokens.append(ordered.tobytes())
            prefix.append(head[head >= np.uint64(2 << 56)].view(np.int64))
        at = owner[out]
        place = pa.StructArray.from_arrays([pa.array(x) for x in (
            deal.ids_of(rows)[at], rows["th"].to_numpy()[at], twins(rows)[at], number[out])], fields=list(_PLACE))
        lists = pa.list_(pa.int32())
        one = pa.table({
            "gid": pa.array(np.full(len(out), gid, np.int32)),
            "node": pa.array([digest[i].tobytes() for i in out], pa.binary()), "place": place,
            "rows": pa.array(at.astype(np.int32).reshape(-1, 1).tolist(), lists),
            "lines": pa.array(number[out].astype(np.int32).reshape(-1, 1).tolist(), lists),
            "tokens": pa.array(tokens, pa.binary()), "prefix": pa.array(prefix, pa.list_(pa.int64())),
        })
        rest = {"gid": [gid], "node": [None], "place": [None], "rows": [owner[gone].astype(np.int32)],
                "lines": [number[gone].astype(np.int32)], "tokens": [None], "prefix": [None]}
        return pa.concat_tables([one, pa.table(rest, schema=one.schema)])
    return of


def later_matches(percent: int):
    """Nodes with an earlier similar node, among the lines that share a token."""
    def of(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("token", "ascending"), *((f"p{k}", "ascending") for k in range(4))])
        token, node = rows["token"].to_numpy(), rows["node"].to_pylist()
        arrays = [np.frombuffer(t, np.uint64) for t in rows["tokens"].to_pylist()]
        heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        found: set[bytes] = set()
        sets: dict[int, frozenset] = {}
        for start, end in zip(heads, np.append(heads[1:], len(token))):
            if end - start < 2:
                continue
            sizes = np.array([len(a) for a in arrays[start:end]])
            at = np.array([int(np.searchsorted(a, token[start:start + 1].view(np.uint64)[0])) for a in arrays[start:end]])
            for y in range(1, end - start):
                if node[start + y] in found:
                    continue
                need = -(-percent * (sizes[y] + sizes[:y]) // (100 + percent))
                best = 1 + np.minimum(sizes[y] - at[y] - 1, sizes[:y] - at[:y] - 1)
                fits = (best >= need) & (100 * np.minimum(sizes[y], sizes[:y]) >= percent * np.maximum(sizes[y], sizes[:y]))
                for x in np.flatnonzero(fits):
                    a, b = (sets.setdefault(start + k, frozenset(arrays[start + k].tolist())) for k in (x, y))
                    if node[start + x] != node[start + y] and len(a & b) >= need[x]:
                        found.add(node[start + y])
                        break
            sets.clear()
        return pa.table({"node": pa.array(sorted(found), pa.binary())})
    return of


def without_lines(rows: pa.Table, gone: pa.Table) -> pa.Table:
    """The group's rows without the lines named."""
    rows = deal.in_order(rows)
    drop: dict[int, set[int]] = {}
    for which, lines in zip(gone["rows"].to_pylist(), gone["lines"].to_pylist()):
        for row, line in zip(which, lines):
            drop.setdefault(row, set()).add(line)
    texts, counts = rows["text"].to_pylist(), []
    for row, text in enumerate(texts):
        bad = drop.get(row)
        counts.append(0 if text is None else text.count("\n") + 1)
        if bad:
            texts[row] = "\n".join([x for k, x in enumerate(text.split("\n")) if k not in bad])
    return pa.table([rows["doc_id"], pa.array(texts, pa.string()), rows["rest"], pa.array(counts, pa.int64()),
                     pa.array([len(drop.get(row, ())) for row in range(len(texts))], pa.int64())],
                    names=["doc_id", "text", "rest", "n_lines", "n_removed"])


def dedup_lines(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Every row of ``docs`` without its later matches: ``doc_id, text, rest, n_lines, n_removed``.

    Lines are cut at ``\\n``. A line goes when an earlier one, by (doc_id, hash of the text, line
    number) and judged on the input, has a Jaccard similarity of ``percent`` of distinct shingles
    of ``width`` words, equal ones included. A line of fewer words goes when an earlier one has the
    same words; lines without words always stay.
    ``rest`` holds all other columns, whatever their names. Null text has no lines and stays null;
    a text can become empty; null ids come last; of repeated rows the first in the order is the
    earlier. Equal ids with different texts are ordered by a hash of the text.
    """
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = docs.select("doc_id", "text", (F.struct(*rest) if rest else F.lit(True)).alias("rest"))
    parts = deal.buckets(spark)
    groups = kept.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text", "rest")
    groups = groups.select(F.pmod(F.xxhash64("doc_id", "th"), F.lit(parts)).cast("int").alias("gid"), "*")
    flags = earliest(groups, width)
    answers = deal.ask(groups, features(width, percent, parts), flags)
    both = flags.withColumn("kind", F.lit(0)).union(answers.withColumn("kind", F.lit(1)))
    lines = written(groups.groupBy("gid").cogroup(both.groupBy("gid")).applyInArrow(
        candidate_lines(width, percent, parts), _LINE), "lines")
    # words that several distinct lines have in their prefixes, without the tokens of the lines yet
    narrow = lines.select("node", F.explode("prefix").alias("token"))
    shared = narrow.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "token", F.ceil(F.col("n") / BLOCK_LINES).cast("int").alias("blocks"))
    postings = narrow.join(shared, "token")
    tasks = postings.join(lines.filter("node is not null").select("node", "place", "tokens"), "node").withColumns({
        "own": F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"),
        "other": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)),
    }).select(F.when(F.col("blocks") == 1, F.concat(F.lit("all "), F.pmod(F.xxhash64("token"), F.lit(parts)))).otherwise(
        F.concat_ws(" ", "token", F.least("own", "other"), F.greatest("own", "other"))).alias("task"),
        "token", "node", "tokens", *(F.col(f"place.{k}").alias(f"p{i}") for i, k in enumerate(("doc_id", "th", "twin", "line"))))
    found = tasks.groupBy("task").applyInArrow(later_matches(percent), "node binary").distinct()
    found = written(found, "later-lines")
    gone = lines.filter("node is null").select("gid", "rows", "lines").union(
        lines.filter("node is not null").select("node", "gid", "rows", "lines").join(found, "node", "left_semi").drop("node"))
    out = kept.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "rest").schema.add("n_lines", "long").add("n_removed", "long")
    return groups.groupBy("gid").cogroup(gone.groupBy("gid")).applyInArrow(without_lines, out)


@query("op6_line_dedup")
def op6(spark, folder):
    """``doc_id, n_lines, n_removed, kept_sha256`` (lower-case hex of the remaining text)."""
    return dedup_lines(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
