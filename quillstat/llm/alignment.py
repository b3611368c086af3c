"""Cross-tokenizer alignment of exactly de-duplicated texts.

Texts are shuffled by their whole text, so that each distinct one is tokenised and aligned once,
with the number of its copies as weight. Pairs of token ids are counted by documents: every file
of the written alignments counts its own pairs, the counts of all files are added by pair, and
each file gets back the totals of its own pairs only. No table of all pairs is ever broadcast and
a pair of every document costs one row a file.
"""

import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import query, table, written

A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Both vocabularies are broadcast; larger files are refused.
VOCABULARY_BYTES = 64 << 20
#: Bytes of text that are aligned in one go, about; a longer text is one alone.
TOGETHER = 1 << 18
#: Distinct texts in one file of alignments, the unit that asks for totals.
FILE_TEXTS = 50_000
_SIZES = ["n_a", "n_b", "n_groups", "n_links"]
COLUMNS = [*_SIZES, "n_best", "count_sum", "groups"]


class Vocabularies:
    """Two tokenizers: A a byte-level BPE without prefix space, B a sentencepiece model that adds one."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.encode_a, tokens = _byte_level(a, _byte_letters())
        self.a_table = _Tokens(tokens, "|")
        self.b_table = _Tokens([self._b_piece(k) for k in range(self.b.get_piece_size())], ";")

    def _b_piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """``(sizes, groups, distinct pairs, times each, where each text's pairs end)`` of whole texts.

        ``sizes`` has ``n_a, n_b, n_groups, n_links``; all are zero, and the groups empty, for a text
        that a tokenizer does not give back byte for byte. All texts are aligned in one go.
        """
        count = len(texts)
        raw = [b" " + t.encode() for t in texts]
        size = np.array([len(r) for r in raw])
        sides = [_Side([self.encode_a(" " + t) for t in texts], self.a_table),
                 _Side(self.b.encode(texts, num_threads=1), self.b_table)]
        fits = np.logical_and(*[np.bincount(s.owner, weights=s.width, minlength=count) == size for s in sides])
        if fits.any():
            given = np.frombuffer(b"".join(r for r, f in zip(raw, fits) if f), np.uint8)
            owner = np.repeat(np.flatnonzero(fits), size[fits])
            for wrong in [owner[side.only(fits).bytes() != given] for side in sides]:
                fits[wrong] = False
        left, right = (s.only(fits) for s in sides)
        common = np.intersect1d(left.end, right.end, assume_unique=True)
        ga, gb = np.searchsorted(common, left.end), np.searchsorted(common, right.end)
        per_group = np.bincount(gb, minlength=len(common))
        # Every A token of a group meets the group's B tokens.
        meets = per_group[ga]
        first = (np.cumsum(per_group) - per_group)[ga]
        inside = np.arange(meets.sum()) - np.repeat(np.cumsum(meets) - meets, meets)
        kinds = len(self.a_table.data) * len(self.b_table.data)
        codes = np.repeat(left.ids, meets) * len(self.b_table.data) + right.ids[np.repeat(first, meets) + inside]
        keys, times = np.unique(np.repeat(left.owner, meets) * kinds + codes, return_counts=True)
        sizes = np.stack([
            np.bincount(left.owner, minlength=count), np.bincount(right.owner, minlength=count),
            np.bincount(left.owner[np.flatnonzero(np.diff(ga, append=-1))], minlength=count),
            np.bincount(left.owner, weights=meets, minlength=count).astype(np.int64)], axis=1)
        shown, widths = _shown(left, right, ga, gb)
        stops = np.concatenate([[0], np.cumsum(widths)])[np.cumsum(sizes[:, 0] + sizes[:, 1])]
        starts = np.concatenate([[0], stops[:-1]])
        groups = [shown[x:max(x, y - 1)] for x, y in zip(starts.tolist(), stops.tolist())]
        return sizes, groups, keys % kinds, times, np.searchsorted(keys // kinds, np.arange(1, count + 1))


class _Tokens:
    """Bytes of all tokens, and their numbers in writing with what stands behind them."""

    def __init__(self, data: list[bytes], behind: str):
        self.data = data
        self.width = np.array([len(d) for d in data])
        self.start = np.cumsum(self.width) - self.width
        self.bytes = np.frombuffer(b"".join(data), np.uint8)
        self.more = np.array([f"{k}," for k in range(len(data))], object)
        self.last = np.array([f"{k}{behind}" for k in range(len(data))], object)
        self.shown = np.array([len(x) for x in self.more])


class _Side:
    """The tokens of many texts in a row: ids, the text of each, byte widths and ends."""

    def __init__(self, encoded: list[list[int]] | None, table: _Tokens, parts: tuple | None = None):
        self.table = table
        if parts is None:
            parts = (np.array(list(chain.from_iterable(encoded)), np.int64), np.repeat(np.arange(len(encoded)), [len(x) for x in encoded]))
        self.ids, self.owner = parts
        self.width = table.width[self.ids]
        self.end = np.cumsum(self.width)

    def only(self, kept: np.ndarray) -> "_Side":
        here = kept[self.owner]
        return self if here.all() else _Side(None, self.table, (self.ids[here], self.owner[here]))

    def bytes(self) -> np.ndarray:
        at = np.repeat(self.table.start[self.ids] - (self.end - self.width), self.width) + np.arange(self.width.sum())
        return self.table.bytes[at]


def _shown(left: _Side, right: _Side, ga: np.ndarray, gb: np.ndarray) -> tuple[str, np.ndarray]:
    """The groups of all texts as one string, ``a1,a2|b1;`` each, and the width of each token in it."""
    order = np.argsort(np.concatenate([2 * ga, 2 * gb + 1]), kind="stable")
    texts, widths = [], []
    for side, group in ((left, ga), (right, gb)):
        last = np.diff(group, append=-1) != 0
        texts.append(np.where(last, side.table.last[side.ids], side.table.more[side.ids]))
        widths.append(side.table.shown[side.ids])
    return "".join(np.concatenate(texts)[order].tolist()), np.concatenate(widths)[order]


#: How byte-level vocabularies cut a text into words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_level(data: bytes, letters: dict[str, int]) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder of a text, and the bytes of all tokens.

    Where the ids of a plain byte-level file rise with its merges, ranks alone decide the merges and
    a faster encoder of the same vocabulary is used.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(data.decode())
    own.encode_special_tokens = True
    tokens = [_decoded(own.id_to_token(k), letters) for k in range(own.get_vocab_size())]
    about = json.loads(data)
    model, before = about["model"], about["pre_tokenizer"] or {}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
    plain = (
        model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not about["normalizer"] and not before.get("add_prefix_space")
        and all(model["vocab"].get(m.replace(" ", "", 1)) == 256 + k for k, m in enumerate(merges))
        and all(len(t) == 1 for t in tokens[:256]))
    if plain:
        import tiktoken

        ranks = {tokens[k]: k for k in range(256 + len(merges))}
        fast = tiktoken.Encoding("byte-level", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
        return fast.encode_ordinary, tokens
    return lambda text: own.encode(text, add_special_tokens=False).ids, tokens


def _byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable Latin-1 letters are
    themselves, the other bytes in order the letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def _decoded(token: str, letters: dict[str, int]) -> bytes:
    return bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()


def _read(path: str) -> bytes:
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path}: a vocabulary of over {VOCABULARY_BYTES} bytes is not broadcast")
    with open(path, "rb") as file:
        return file.read()


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about TOGETHER bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(sizes) - sizes) // TOGETHER
    borders = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    yield from (batch.slice(x, y - x) for x, y in zip(borders, borders[1:]) if y > x)


def align_texts(texts: DataFrame, *, a: str = A_FILE, b: str = B_FILE) -> DataFrame:
    """``texts`` (with a column ``text``, which goes) with sizes, ``groups`` as text, and the distinct
    ``pairs`` (A id times size of B, plus B id) with the ``times`` each is linked.

    A null or empty text, or one that a tokenizer does not give back byte for byte, has zeros, no
    groups and no pairs. The files are read on the driver and travel to the tasks.
    """
    files = texts.sparkSession.sparkContext.broadcast((_read(a), _read(b)))
    kept = [c for c in texts.columns if c != "text"]

    def of(batches):
        own = Vocabularies(*files.value)
        for batch in chain.from_iterable(map(_slices, batches)):
            given = batch.column("text").to_pylist()
            have = np.array([k for k, t in enumerate(given) if t], np.int64)
            sizes, groups, many = np.zeros((len(given), 4), np.int64), [""] * len(given), np.zeros(len(given), np.int64)
            pairs = times = np.zeros(0, np.int64)
            if len(have):
                sizes[have], names, pairs, times, ends = own.align([given[k] for k in have])
                many[have] = np.diff(ends, prepend=0)
                for k, name in zip(have.tolist(), names):
                    groups[k] = name
            ends = pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(sizes[:, k]) for k in range(4)), pa.array(groups, pa.string()),
                 *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in (pairs, times))],
                names=[*kept, *_SIZES, "groups", "pairs", "times"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields if f.name != "text"]
    sizes = ", ".join(f"{n} long" for n in _SIZES)
    return texts.mapInArrow(of, ", ".join([*fields, sizes, "groups string, pairs array<long>, times array<long>"]))


def _totals(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Links by the totals of their pairs, for the texts of one file."""
    pairs = np.asarray(answers["pair"], np.int64)
    order = np.argsort(pairs)
    pairs, counts = pairs[order], np.asarray(answers["n"], np.int64)[order]
    best = np.asarray(answers["best"]).astype(np.int64)[order]
    asked = rows["pairs"].combine_chunks()
    # A text without pairs is an empty stretch between two equal ends.
    codes, ends = np.asarray(asked.flatten(), np.int64), np.cumsum([0, *asked.value_lengths().to_pylist()])
    times = np.asarray(rows["times"].combine_chunks().flatten(), np.int64)
    at = np.searchsorted(pairs, codes)

    def added(weights):
        total = np.concatenate([[0], np.cumsum(weights * times)])
        return pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64())

    if not len(pairs):
        zero = pa.array(np.zeros(len(rows), np.int64))
        return rows.drop_columns(["file", "pairs", "times"]).append_column("n_best", zero).append_column("count_sum", zero)
    return rows.drop_columns(["file", "pairs", "times"]).append_column("n_best", added(best[at])).append_column(
        "count_sum", added(counts[at]))


def align_documents(docs: DataFrame, *, a: str = A_FILE, b: str = B_FILE, text: str = "text",
                    groups_as: Callable[[Column], Column] = lambda groups: groups) -> DataFrame:
    """``docs`` with ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``groups_as`` renders the groups (``a1,a2|b1;a3|b2``) before they are stored, such as a digest.
    Rows that repeat each count as a document. Null, empty and not invertible texts have zeros and
    the rendering of no groups; an empty table gives none. Existing columns of the new names are
    refused.
    """
    clash = set(COLUMNS) & set(docs.columns)
    if clash:
        raise ValueError(f"docs already has columns {sorted(clash)}")
    given = F.col(f"`{text}`")
    key = F.unhex(F.sha2(given, 256))
    copies = docs.select(given.alias("text")).filter("text is not null").groupBy("text").agg(
        F.count(F.lit(1)).alias("copies"))
    aligned = align_texts(copies.withColumn("key", F.unhex(F.sha2("text", 256))), a=a, b=b).withColumn(
        "groups", groups_as(F.col("groups")))
    # What a file asks for is read from the file's name, so a lost task cannot change it.
    stored = written(aligned, "alignments", maxRecordsPerFile=FILE_TEXTS).withColumn(
        "file", F.xxhash64("_metadata.file_path"))
    asked = written(stored.select("file", "copies", F.explode("pairs").alias("pair")).groupBy("file", "pair").agg(
        F.sum("copies").alias("n")), "pairs")
    size = _pieces(b)
    counts = asked.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"pair div {size}"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    answers = asked.select("file", "pair").join(
        counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair")
    rows = stored.select("file", "key", *_SIZES, "groups", "pairs", "times")
    schema = f"key binary, {', '.join(f'{n} long' for n in _SIZES)}, groups {dict(aligned.dtypes)['groups']}, n_best long, count_sum long"
    measured = rows.groupBy("file").cogroup(answers.groupBy("file")).applyInArrow(_totals, schema)
    mark = "_key"
    while mark in docs.columns:
        mark += "_"
    joined = docs.withColumn(mark, key).join(measured, F.col(mark) == measured["key"], "left")
    zeros = [F.coalesce(F.col(n), F.lit(0).cast("long")).alias(n) for n in COLUMNS[:-1]]
    return joined.select(*[docs[c] for c in docs.columns], *zeros,
                         F.coalesce(measured["groups"], groups_as(F.lit(""))).alias("groups"))


def _pieces(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=_read(path)).get_piece_size()


@query("op11_tokenizer_alignment")
def op11(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = align_documents(docs, groups_as=lambda g: F.when(g == "", g).otherwise(F.sha2(g, 256)))
    return out.select("doc_id", *COLUMNS[:-1], F.col("groups").alias("groups_sha256"))
