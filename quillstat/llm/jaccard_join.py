"""Prefix-tree join: documents whose word-shingle sets have a Jaccard similarity of 0.75 or more.

1. Each document becomes the set of its hashed shingles. ``deal`` says which shingles occur in
   several groups of documents. A document with fewer than 75 % such shingles has no partner.
2. The rest, one row per distinct set, is ordered by rarity. Two linked sets share a token of
   their prefixes, so sets that share prefix tokens, directly or through others, are brought
   together. A set that large is cut into blocks, and pairs of blocks are joined.
3. There the ordered sets go into a radix tree. A probe walks it with the overlap so far, shared
   by all sets below, and leaves a subtree when the tokens left cannot reach the threshold, or
   when everything below already belongs to the probe's component.

Results are links of a spanning forest, never pairs; a class of n copies is one set.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import deal
from .common import query, table, written
from .components import components
from .shingles import mix, shingle_sets, text_slices

WIDTH, PERCENT = 5, 75
#: Tokens of the sets that one task joins at a time; more of them are joined in pairs of blocks.
BLOCK_TOKENS = 1_000_000
_ROW = "gid int, doc_id long, th long, n_shingles long, node binary, tokens binary, prefix array<long>"


def document_sets(rows: pa.Table, width: int, short: bool = True):
    """``(hashes, bounds, digests)`` of the sets of all rows; equal sets have equal digests."""
    parts, sizes = [], []
    for _, data, offsets in text_slices(rows["text"]):
        hashes, bounds = shingle_sets(data, offsets, width, short=short)
        parts.append(hashes)
        sizes.append(np.diff(bounds))
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
    return hashes, bounds, digests(hashes, bounds)


def digests(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits a set, whatever its order."""
    out = np.zeros((len(bounds) - 1, 2), np.uint64)
    for k, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)), dtype=np.uint64)])
        out[:, k] = mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ np.diff(bounds).astype(np.uint64))
    return np.ascontiguousarray(out).view("V16").ravel()


def one_of_each(digest: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """True for the first row of each distinct set that is not empty."""
    first = np.zeros(len(digest), bool)
    pairs = digest.view(np.uint64).reshape(-1, 2)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    new = np.ones(len(digest), bool)
    new[1:] = (pairs[order][1:] != pairs[order][:-1]).any(axis=1)
    first[order[new]] = True
    return first & (sizes > 0)


def rarity_keys(hashes: np.ndarray, bounds: np.ndarray, keep: np.ndarray, answers: pa.Table, number: int):
    """``(order keys, several?)`` of the kept rows' tokens: 8 bits of group frequency, 56 of hash."""
    of = np.repeat(keep, np.diff(bounds))
    distinct, back = np.unique(hashes[of], return_inverse=True)
    counts = deal.answered(answers, distinct, number)[back] if len(distinct) else np.zeros(0, np.uint8)
    keys = np.zeros(len(hashes), np.uint64)
    keys[of] = (counts.astype(np.uint64) << np.uint64(56)) | (hashes[of] >> np.uint64(8))
    several = np.zeros(len(hashes), bool)
    several[of] = counts > 1
    return keys, several


def features(width: int):
    def of(rows: pa.Table):
        hashes, bounds, digest = document_sets(rows, width)
        keep = one_of_each(digest, np.diff(bounds))
        distinct, counts = np.unique(hashes[np.repeat(keep, np.diff(bounds))], return_counts=True)
        return distinct, counts > 1
    return of


def candidate_rows(width: int, percent: int, number: int):
    def of(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table({n: pa.array([], t) for n, t in (
                ("gid", pa.int32()), ("doc_id", pa.int64()), ("th", pa.int64()), ("n_shingles", pa.int64()),
                ("node", pa.binary()), ("tokens", pa.binary()), ("prefix", pa.list_(pa.int64())))})
        rows = deal.in_order(rows)
        hashes, bounds, digest = document_sets(rows, width)
        sizes = np.diff(bounds)
        keep = one_of_each(digest, sizes)
        keys, several = rarity_keys(hashes, bounds, keep, answers, number)
        sums = np.concatenate([[0], np.cumsum(several)])
        shared = sums[bounds[1:]] - sums[bounds[:-1]]
        keep &= 100 * shared >= percent * sizes
        tokens, prefix = [None] * len(rows), [None] * len(rows)
        for i in np.flatnonzero(keep):
            ordered = np.sort(keys[bounds[i]:bounds[i + 1]])
            n = len(ordered)
            head = ordered[: n - -(-percent * n // 100) + 1]
            tokens[i] = ordered.tobytes()
            prefix[i] = head[head >= np.uint64(2 << 56)].view(np.int64)
        return pa.table({
            "gid": rows["gid"], "doc_id": rows["doc_id"], "th": rows["th"], "n_shingles": pa.array(sizes),
            "node": pa.array([d if n else None for d, n in zip(digest.tolist(), sizes)], pa.binary()),
            "tokens": pa.array(tokens, pa.binary()), "prefix": pa.array(prefix, pa.list_(pa.int64())),
        })
    return of


class _Node:
    __slots__ = ("segment", "last", "depth", "below", "ends", "least", "most", "one", "uniform")

    def __init__(self, segment: list[int], depth: int):
        self.segment, self.depth = segment, depth
        self.last = segment[-1] if segment else 0
        self.below, self.ends, self.uniform = [], [], False


class PrefixTree:
    """Radix tree over sets of numbers, each in rising order, that joins them by Jaccard."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent, self.parent = sets, percent, list(range(len(sets)))
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.root = _Node([], 0)
        path, before = [self.root], None
        for i in order:
            depth = 0 if before is None else _common(sets[before], sets[i])
            last = None
            while path[-1].depth > depth:
                last = path.pop()
            top = path[-1]
            if top.depth < depth:  # the new set leaves inside a segment: cut it there
                cut = depth - top.depth
                middle = _Node(last.segment[:cut], depth)
                last.segment = last.segment[cut:]
                middle.below.append(last)
                top.below[-1] = top = middle
                path.append(middle)
            if depth < len(sets[i]):
                top.below.append(_Node(sets[i][depth:].tolist(), len(sets[i])))
                path.append(top.below[-1])
            path[-1].ends.append(i)
            before = i
        self._bounds()

    def _bounds(self):
        todo, done = [self.root], []
        while todo:
            node = todo.pop()
            done.append(node)
            todo += node.below
        for node in reversed(done):
            node.segment = frozenset(node.segment)
            sizes = [len(self.sets[i]) for i in node.ends]
            node.least = min([*sizes, *(x.least for x in node.below)], default=0)
            node.most = max([*sizes, *(x.most for x in node.below)], default=0)
            node.one = node.ends[0] if node.ends else node.below[0].one if node.below else 0

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def link(self) -> list[int]:
        """The component of each set."""
        for i in sorted(range(len(self.sets)), key=lambda i: -len(self.sets[i])):
            self._probe(i)
        return [self.find(i) for i in range(len(self.sets))]

    def _probe(self, i: int) -> None:
        own = self.sets[i]
        mine, size, percent = set(own.tolist()), len(own), self.percent
        todo = [(self.root, 0, False)]
        while todo:
            node, overlap, leaving = todo.pop()
            if leaving:
                roots = {self.find(j) for j in node.ends} | {self.find(x.one) for x in node.below}
                node.uniform = len(roots) == 1 and all(x.uniform for x in node.below)
                continue
            if node.least > size or 100 * node.most < percent * size or (
                    node.uniform and self.find(node.one) == self.find(i)):
                continue
            if node.depth:
                overlap += len(mine & node.segment)
                left = size - int(np.searchsorted(own, node.last, side="right"))
                best = overlap + min(left, node.most - node.depth)
                if 100 * best < percent * (size + node.depth - overlap):  # the union holds these at least
                    continue
            for j in node.ends:
                if j != i and 100 * overlap >= percent * (size + len(self.sets[j]) - overlap):
                    a, b = self.find(i), self.find(j)
                    self.parent[max(a, b)] = min(a, b)
            if not node.uniform:
                todo.append((node, overlap, True))
            todo += [(x, overlap, False) for x in node.below]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n


def forest(percent: int):
    """Links from each set to the smallest set of its component, by component and block pair."""
    def of(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("comp")
        nodes, comps = rows["node"].to_pylist(), rows["comp"].to_pylist()
        tokens = rows["tokens"].to_pylist()
        a, b, start = [], [], 0
        while start < len(comps):
            end = start
            while end < len(comps) and comps[end] == comps[start]:
                end += 1
            tree = PrefixTree([np.frombuffer(t, np.uint64) for t in tokens[start:end]], percent)
            least: dict[int, bytes] = {}
            labels = tree.link()
            for label, node in zip(labels, nodes[start:end]):
                least[label] = min(node, least.get(label, node))
            for label, node in zip(labels, nodes[start:end]):
                if least[label] != node:
                    a.append(node)
                    b.append(least[label])
            start = end
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
    return of


def similar_classes(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, first`` for every row of ``docs`` (doc_id, text, any others).

    A set holds the distinct shingles of ``width`` words; fewer words make one shingle; no words,
    empty or null text make an empty set that is linked with nothing. Rows that repeat, or share an
    id, each give a row; equal sets are linked. ``component_id`` is the smallest doc_id reachable;
    null ids count as larger than all. ``th`` hashes the text; ``first`` marks the row of a component with
    the smallest (doc_id, th), and rows that repeat it. Shingles are compared by 64-bit hashes, 56 bits of them in
    the join. An empty table gives no rows.
    """
    spark = docs.sparkSession
    groups = deal.grouped(docs)
    answers = deal.ask(groups, features(width))
    rows = written(
        groups.groupBy("gid").cogroup(answers.groupBy("gid")).applyInArrow(
            candidate_rows(width, percent, deal.buckets(spark)), _ROW),
        "sets")
    sets = rows.filter("tokens is not null")
    postings = sets.select("node", F.explode("prefix").alias("token"))
    centres = postings.groupBy("token").agg(F.min("node").alias("b"), F.max("node").alias("top")).filter("b <> top")
    near = components(postings.join(centres, "token").select(F.col("node").alias("a"), "b").distinct())
    near = written(near, "near")
    one = sets.groupBy("node").agg(F.min("gid").alias("gid"), F.max("n_shingles").alias("n")).join(near, "node")
    total = one.groupBy("label").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("blocks"))
    placed = one.join(total, "label").withColumns({
        "own": F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"),
        "other": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)),
    }).select("node", "gid", F.col("label").alias("comp"), F.when(F.col("blocks") == 1, F.concat(
        F.lit("all "), F.pmod(F.xxhash64("label"), F.lit(deal.buckets(spark))),
    )).otherwise(F.concat_ws(" ", F.hex("label"), F.least("own", "other"), F.greatest("own", "other"))).alias("task"))
    joined = sets.select("node", "gid", "tokens").join(placed, ["node", "gid"]).select("task", "comp", "node", "tokens")
    # Written, because the components read their edges twice.
    links = written(joined.groupBy("task").applyInArrow(forest(percent), "a binary, b binary"), "links")
    labels = components(links)
    last = F.lit((1 << 63) - 1)  # null ids come after all others
    place = F.struct(F.coalesce("doc_id", last).alias("doc_id"), "th")
    owner = rows.filter("node is not null").groupBy("node").agg(F.min(place).alias("least"))
    owner = owner.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    best = owner.groupBy("label").agg(F.min("least").alias("best"))
    owner = owner.join(best, "label").select("node", "best")
    first = F.col("best.doc_id")
    return (
        rows.filter("node is not null").join(owner, "node").select(
            "doc_id", "th", "n_shingles", F.when(first != last, first).alias("component_id"), (place == F.col("best")).alias("first"))
        .union(rows.filter("node is null").select(
            "doc_id", "th", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True)))
    )


@query("op3_jaccard_join")
def op3(spark, folder):
    return similar_classes(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
