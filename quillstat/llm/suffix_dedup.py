"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in an earlier document.

1. Anchors. Each 50-byte window names the 16-byte stretch in it with the smallest hash, the
   leftmost of equal ones. Equal windows name equal anchors, so a window whose anchor occurs in one
   document only is unique. ``deal`` tells the repeated anchors.
2. Excerpts. Windows in a row with one repeated anchor make an excerpt of the text. Equal excerpts
   of a group of documents are sent once, with the places where they stand, to a bucket by anchor.
3. Suffix array. A bucket sorts the suffixes of its excerpts in two stages: those smaller than
   their successors directly, by 50 bytes, the rest induced by one scan over the buckets of first
   bytes. Neighbours with a common prefix of 50 bytes are one class; its smallest doc_id decides
   which windows of which documents go. Their spans return to the documents' group.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import deal
from .common import query, table
from .shingles import Rolling, mix, text_slices

LENGTH, ANCHOR = 50, 16
#: Bytes of excerpts, about, that are sorted at a time within a bucket.
BLOCK_BYTES = 1 << 20
_SEND = "gid int, bucket int, blocks binary, starts binary, bytes binary, counts binary, rows binary, docs binary, places binary"
_SPANS = "gid int, rows binary, begins binary, ends binary"


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, width: int):
    """``(anchor hash, first window, number of windows, row, hashes of any stretch)`` of windows in a
    row with one anchor."""
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none, None
    rolling = Rolling(data)
    hashes = rolling.windows(width)
    span = length - width + 1
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    covered = 1
    while covered < span:
        step = min(covered, span - covered)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    valid = np.ones(n, bool)
    for end in offsets[1:]:
        valid[max(0, end - length + 1):end] = False
    head = valid.copy()
    head[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    start = np.flatnonzero(head)
    tail = valid.copy()
    tail[:-1] &= (at[1:] != at[:-1]) | ~valid[1:]
    number = np.flatnonzero(tail) + 1 - start
    anchor = mix(hashes[at[start]] ^ np.uint64(0xA0761D6478BD642F))
    return anchor, start, number, np.searchsorted(offsets, start, side="right") - 1, rolling


def features(length: int, width: int):
    def of(rows: pa.Table):
        found, ids = [], deal.ids_of(rows)
        for row, data, offsets in text_slices(rows["text"]):
            hashes, _, _, owner, _ = anchors(data, offsets, length, width)
            order = np.argsort(hashes)
            hashes, docs = hashes[order], ids[row + owner[order]]
            heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
            if len(heads):
                found.append((hashes[heads], np.minimum.reduceat(docs, heads), np.maximum.reduceat(docs, heads)))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        hashes, low, high = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(hashes)
        hashes, low, high = hashes[order], low[order], high[order]
        heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        return hashes[heads], np.minimum.reduceat(low, heads) != np.maximum.reduceat(high, heads)
    return of


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers start, start + 1, ... of each stretch, one after the other."""
    ends = np.cumsum(counts)
    kind = np.int32 if not len(ends) or max(ends[-1], (starts + counts).max()) < 2**31 else np.int64
    return np.arange(ends[-1] if len(ends) else 0, dtype=kind) + np.repeat((starts - (ends - counts)).astype(kind), counts)


def _run_kind(length: int) -> type:
    """Of the numbers of windows of an excerpt, at most one for each byte of ``length``."""
    return np.uint8 if length < 256 else np.uint32


def excerpts(length: int, width: int, number: int):
    """A group's distinct excerpts with repeated anchors, and where they stand, by bucket."""
    def of(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table({f: pa.array([], pa.int32() if k < 2 else pa.binary()) for k, f in enumerate(
                x.split()[0] for x in _SEND.split(", "))})
        rows = deal.in_order(rows)
        ids = deal.ids_of(rows)
        parts = []
        for row, data, offsets in text_slices(rows["text"]):
            hashes, start, runs, owner, roll = anchors(data, offsets, length, width)
            if len(hashes):
                parts.append((hashes, runs, row + owner, start - offsets[owner],
                              roll.of(start, start + runs + length - 1), start, data))
        if not parts:
            return of(rows.slice(0, 0), answers)
        distinct = np.unique(np.concatenate([p[0] for p in parts]))
        counts = deal.answered(answers, distinct, number)
        base, chosen = 0, []
        for p in parts:
            seen = counts[np.searchsorted(distinct, p[0])] > 1
            chosen.append([x[seen] for x in p[:5]] + [p[5][seen] + base])
            base += len(p[6])
        hashes, runs, row, place, content, start = (np.concatenate(x) for x in zip(*chosen))
        data = np.concatenate([p[6] for p in parts])
        order = np.argsort(content)  # of the bytes and their number
        order = order[np.argsort(deal.buckets_of(hashes[order], number), kind="stable")]
        hashes, runs, row, place, content, start = (x[order] for x in (hashes, runs, row, place, content, start))
        bucket = deal.buckets_of(hashes, number)
        new = np.ones(len(hashes), bool)
        new[1:] = (content[1:] != content[:-1]) | (bucket[1:] != bucket[:-1])
        heads = np.flatnonzero(new)
        times = np.diff(np.append(heads, len(hashes)))
        gid, out = rows["gid"][0].as_py(), []
        edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[heads]) != 0])) if len(heads) else []
        for a, b in zip(edges, [*edges[1:], len(heads)]):
            own = heads[a:b]
            one, last = own[0], heads[b] if b < len(heads) else len(hashes)
            text = data[ranges(start[own], runs[own] + length - 1)]
            block = (hashes[own] & np.uint64(0xFF)).astype(np.uint8)  # equal anchors, equal blocks
            out.append((gid, int(bucket[one]), block.tobytes(), runs[own].astype(_run_kind(length)).tobytes(), text.tobytes(),
                        times[a:b].astype(np.uint32).tobytes(), row[one:last].astype(np.uint32).tobytes(),
                        ids[row[one:last]].astype(np.int64).tobytes(), place[one:last].astype(np.uint32).tobytes()))
        return pa.Table.from_arrays([pa.array([r[k] for r in out], pa.int32() if k < 2 else pa.binary()) for k in range(9)],
                                    names=[x.split()[0] for x in _SEND.split(", ")])
    return of


def two_stage_order(text: np.ndarray, wanted: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(suffix array of the wanted places, shares `length` bytes with the one before?)``.

    ``text`` holds values 1 to 256 and a 0 after each excerpt. Suffixes smaller than their
    successors are sorted directly, by their first ``length`` values; each other one follows from
    its successor in one scan over the buckets of first values.
    """
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    rising = np.zeros(len(ends), bool)
    rising[:-1] = text[ends[:-1]] < text[ends[:-1] + 1]
    smaller = np.repeat(rising, np.diff(np.concatenate([[-1], ends])))
    smaller |= text == 0  # ends of excerpts precede all and are not told apart
    # each wanted place, and what follows it up to the first that is sorted directly
    next_direct = np.flatnonzero(smaller)
    last = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
    used = wanted.copy()
    used[ranges(last, next_direct[np.searchsorted(next_direct, last)] - last + 1)] = True
    words_ = -(-length // 8)
    padded = np.zeros(n + 8 * (words_ + 1), np.uint8)
    padded[:n] = np.maximum(text - 1, 0)
    eight = np.zeros(n + 8 * words_, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k:k + len(eight)]
    left = 8 * words_ - length

    def key(places: np.ndarray, k: int) -> np.ndarray:
        value = eight[places + 8 * k]
        return value >> np.uint64(8 * left) if k == words_ - 1 else value

    direct = np.flatnonzero(used & smaller)
    # bytes past the end of an excerpt only matter after `length` values of a wanted suffix
    # equal beginnings, by their hashes, are sorted once
    hashed = Rolling(padded[:n + length]).windows(length)[direct] ^ (text[direct] > 0)
    by_hash = np.argsort(hashed)
    new = np.append(True, hashed[by_hash[1:]] != hashed[by_hash[:-1]]) if len(direct) else np.zeros(0, bool)
    one = direct[by_hash[new]]
    rank = np.empty(len(one), np.int64)
    rank[np.lexsort([*(key(one, k) for k in reversed(range(words_))), text[one] > 0])] = np.arange(len(one))
    places = np.empty(len(direct), np.int64)
    places[by_hash] = rank[np.cumsum(new) - 1]
    direct = direct[np.argsort(places)]
    first = text[direct]
    bounds = np.searchsorted(first, np.arange(258)) if len(first) else np.zeros(258, np.int64)
    induced: list[list[np.ndarray]] = [[] for _ in range(257)]
    order = []

    def scan(places: np.ndarray, value: int) -> np.ndarray:
        """Induce the places before; those with the value of this bucket are returned."""
        before = places[places > 0] - 1
        before = before[used[before] & ~smaller[before] & (text[before] >= value)]
        firsts = text[before]
        sort = np.argsort(firsts, kind="stable")
        cuts = np.flatnonzero(np.diff(firsts[sort])) + 1
        for part in np.split(before[sort], cuts):
            if len(part) and text[part[0]] != value:
                induced[text[part[0]]].append(part)
        return before[firsts == value]

    for value in range(257):
        now = np.concatenate(induced[value]) if induced[value] else np.zeros(0, np.int64)
        while len(now):
            order.append(now)
            now = scan(now, value)
        now = direct[bounds[value]:bounds[value + 1]]
        if len(now):
            order.append(now)
            scan(now, value)
        induced[value] = []
    order = np.concatenate(order) if order else np.zeros(0, np.int64)
    order = order[wanted[order]]
    same = np.zeros(len(order), bool)
    if len(order) > 1:
        same[1:] = True
        for k in range(words_):
            part = key(order, k)
            same[1:] &= part[1:] == part[:-1]
    return order, same


def spans(length: int):
    """Windows of a bucket that also start in an earlier document, as spans of bytes by group."""
    def of(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("gid")

        def all_of(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(rows[name].to_pylist()), kind)

        blocks, runs, times = all_of("blocks", np.uint8), all_of("starts", _run_kind(length)).astype(np.int64), all_of("counts", np.uint32).astype(np.int64)
        raw, row, docs, places = all_of("bytes", np.uint8), all_of("rows", np.uint32), all_of("docs", np.int64), all_of("places", np.uint32)
        groups = np.repeat(rows["gid"].to_numpy(), [len(x) // 4 for x in rows["rows"].to_pylist()])
        sizes = runs + length - 1
        begin, heads = np.cumsum(sizes) - sizes, np.cumsum(times) - times
        number = max(1, min(256, int(sizes.sum()) // BLOCK_BYTES))
        found = []
        for block in range(number):  # equal windows have equal anchors, so blocks are independent
            chosen = np.flatnonzero(blocks.astype(np.int64) * number >> 8 == block)
            if len(chosen):
                at = ranges(heads[chosen], times[chosen])
                start, end, which = _block_spans(raw[ranges(begin[chosen], sizes[chosen])], runs[chosen], times[chosen],
                                                 docs[at], places[at].astype(np.int64), length)
                found.append((groups[at[which]], row[at[which]], start, end))
        if not found:
            return pa.table({n: pa.array([], pa.int32() if n == "gid" else pa.binary()) for n in ("gid", "rows", "begins", "ends")})
        gid, row, start, end = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(gid, kind="stable")
        gid, row, start, end = gid[order], row[order], start[order], end[order]
        edges = np.flatnonzero(np.append(True, np.diff(gid) != 0)) if len(gid) else np.zeros(0, np.int64)
        parts = list(zip(edges, [*edges[1:], len(gid)]))
        return pa.table({
            "gid": pa.array([int(gid[a]) for a, _ in parts], pa.int32()),
            **{n: pa.array([x[a:b].astype(np.uint32).tobytes() for a, b in parts], pa.binary())
               for n, x in (("rows", row), ("begins", start), ("ends", end))},
        })
    return of


def _block_spans(raw, runs, times, docs, places, length: int):
    """``(begin, end, place)`` of the spans that go, of excerpts with ``runs`` windows each that stand
    ``times`` times: ``docs`` and ``places`` of the first, then of the second, and so on."""
    sizes = runs + length - 1
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int((sizes + 1).sum()), np.int16)
    inside = ranges(begin, sizes)
    text[inside] = raw
    text[inside] += 1
    owner = np.zeros(len(text), np.int32)
    owner[inside] = np.repeat(np.arange(len(runs), dtype=np.int32), sizes)
    wanted = np.zeros(len(text), bool)
    wanted[ranges(begin, runs)] = True
    order, same = two_stage_order(text, wanted, length)
    earliest = np.minimum.reduceat(docs, np.cumsum(times) - times)  # of the places of an excerpt
    heads = np.flatnonzero(~same)
    least = np.minimum.reduceat(earliest[owner[order]], heads)
    smallest = np.empty(len(text), np.int64)
    smallest[order] = np.repeat(least, np.diff(np.append(heads, len(order))))
    # one window after the other, of each place of each excerpt
    excerpt = np.repeat(np.arange(len(runs)), times)
    window = ranges(begin[excerpt], runs[excerpt])
    place = np.repeat(np.arange(len(docs), dtype=np.int32), runs[excerpt])
    gone = np.flatnonzero(smallest[window] < docs[place])
    cut = np.ones(len(gone), bool)
    cut[1:] = (np.diff(gone) > 1) | (place[gone[1:]] != place[gone[:-1]])
    first, last = gone[cut], gone[np.append(cut[1:], True)] if len(gone) else gone
    at = place[first]
    start = places[at] + window[first] - begin[excerpt[at]]
    return start, start + (last - first) + length, at


def kept_bytes(rows: pa.Table, found: pa.Table) -> pa.Table:
    """What is left of each text of a group."""
    rows = deal.in_order(rows)
    row, begin, end = (np.frombuffer(b"".join(found[n].to_pylist()), np.uint32).astype(np.int64) for n in ("rows", "begins", "ends"))
    order = np.lexsort((begin, row))
    row, begin, end = row[order], begin[order], end[order]
    bounds = np.searchsorted(row, np.arange(len(rows) + 1))
    out = []
    for i, text in enumerate(rows["text"].cast(pa.large_binary())):
        text = text.as_py() or b""
        merged: list[list[int]] = []
        for a, b in zip(begin[bounds[i]:bounds[i + 1]].tolist(), end[bounds[i]:bounds[i + 1]].tolist()):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        left, at = [], 0
        for a, b in merged:
            left.append(text[at:a])
            at = b
        left.append(text[at:])
        kept = b"".join(left)
        out.append((len(text), len(text) - len(kept), merged, kept))
    return pa.table({
        "doc_id": rows["doc_id"], "n_bytes": pa.array([x[0] for x in out], pa.int64()),
        "n_removed": pa.array([x[1] for x in out], pa.int64()),
        "spans": pa.array([x[2] for x in out], pa.list_(pa.list_(pa.int64()))),
        "kept": pa.array([x[3] for x in out], pa.binary()),
        "kept_sha256": pa.array([hashlib.sha256(x[3]).hexdigest() for x in out], pa.string()),
    })


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, width: int = ANCHOR, texts: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept, kept_sha256`` for every row (doc_id, text, any others).

    A byte goes when a string of ``length`` bytes over it also starts in a document with a smaller
    doc_id; strings are judged on the input. ``spans`` are the maximal removed runs ``[begin, end)``
    in bytes of the UTF-8 text, ``kept`` the rest (left out without ``texts``), which may cut a
    character. Null text is empty; null ids come after all others; rows with equal ids don't remove
    from each other; shorter texts stay whole. An empty table gives no rows. Excerpts of a group are
    told apart by 64-bit hashes and lengths, everything else by its bytes.
    """
    number = deal.buckets(docs.sparkSession)
    groups = deal.grouped(docs)
    answers = deal.ask(groups, features(length, width))
    sent = groups.groupBy("gid").cogroup(answers.groupBy("gid")).applyInArrow(excerpts(length, width, number), _SEND)
    found = sent.groupBy("bucket").applyInArrow(spans(length), _SPANS)
    fields = [("doc_id", "long"), ("n_bytes", "long"), ("n_removed", "long"), ("spans", "array<array<bigint>>"),
              ("kept", "binary"), ("kept_sha256", "string")]
    fields = [f for f in fields if texts or f[0] != "kept"]

    def rest(rows: pa.Table, cut: pa.Table) -> pa.Table:
        return kept_bytes(rows, cut).select([n for n, _ in fields])

    return groups.groupBy("gid").cogroup(found.groupBy("gid")).applyInArrow(rest, ", ".join(" ".join(f) for f in fields))


@query("op7_suffix_dedup")
def op7(spark, folder):
    out = remove_repeats(table(spark, folder, "documents"), texts=False)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
