"""Spelling variants: words one edit apart, found through an index of variable-length grams.

A gram starts at every place of a word and grows while it stands more often than a threshold in the
vocabulary; the dictionary holds the grams so reached and their order by rarity. One edit can only
change grams that stand over its place. The most that any place has is the word's affected-gram
bound, so of the bound's number of rarest grams and one more, some gram is the same in both words
of a pair, and the rarest such gram is listed by both. Lists of equal grams are merged by an
equi-join and the pairs verified.

A list is cut by what the edit leaves whole: a common gram before the edit has all letters before
it in common, one behind the edit all letters behind it. So a frequent gram makes many short lists.
"""

import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, query, table, written

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_TO_LOWER = str.maketrans(UPPER, LOWER)
#: Shortest word, fewest occurrences, one run in so many loses a code point.
LEAST_LENGTH, LEAST_COUNT, DAMAGE = 5, 3, 97
#: Shortest and longest gram.
SHORT_GRAM, LONG_GRAM = 2, 4
#: A gram grows while it has more than a share of one in FREQUENT of all places, so that the
#: dictionary has at most FREQUENT grams of each length that grow, whatever the vocabulary.
FREQUENT, LEAST_FREQUENT = 20_000, 4
#: Words a task counts before it hands them on.
COUNTED = 200_000


def count_words(docs: DataFrame, *, damage: int = DAMAGE, least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the letter runs of (doc_id, text), A-Z lower-cased.

    A run whose ``crc32("<doc_id>:<run>")`` is divisible by ``damage`` loses the code point at
    that number modulo its length; a null doc_id reads as "". Null texts have no words. Words
    shorter or rarer than the least are left out. Tasks add up their counts before the shuffle.
    """
    def of(batches):
        total: dict[str, int] = defaultdict(int)

        def flushed():
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                             names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(_RUN.findall(text or "")).items():
                    if not run.islower():
                        run = run.translate(_TO_LOWER)
                    h = zlib.crc32(run.encode(), start)
                    if h % damage == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                    if len(run) >= least_length:
                        total[run] += n
                if len(total) > COUNTED:
                    yield flushed()
        yield flushed()

    counted = docs.select("doc_id", "text").mapInArrow(of, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def gram_dictionary(words: DataFrame, *, longest: int = LONG_GRAM, frequent: int = FREQUENT) -> tuple[dict[str, int], frozenset[str]]:
    """``(rank of every gram by rarity, grams that grow)`` of the distinct ``word`` rows.

    At most ``frequent`` grams of a length grow; a gram is kept if the gram it grew from does.
    """
    padded = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("p"))
    places = padded.agg(F.sum(F.length("p") - 1)).first()[0] or 0
    limit = max(LEAST_FREQUENT, places // frequent)
    starts = padded.select("p", F.explode(F.sequence(F.lit(1), F.length("p") - 1)).alias("i"))
    sizes = F.array([F.lit(k) for k in range(SHORT_GRAM, longest + 1)])
    cut = starts.select(F.explode(F.array_distinct(F.transform(sizes, lambda k: F.col("p").substr(F.col("i"), k)))).alias("gram"))
    counts = written(cut.groupBy("gram").agg(F.count(F.lit(1)).alias("f")), "grams")
    grow = counts.filter((F.col("f") > limit) & (F.length("gram") < longest))
    kept = counts.filter(F.length("gram") == SHORT_GRAM).select("gram", "f").union(
        counts.filter(F.length("gram") > SHORT_GRAM).withColumn("from", F.expr("left(gram, length(gram) - 1)")).join(
            grow.select(F.col("gram").alias("from")), "from", "left_semi").select("gram", "f"))
    rows = sorted((r.f, r.gram) for r in kept.collect())
    return {gram: rank for rank, (_, gram) in enumerate(rows)}, frozenset(r.gram for r in grow.select("gram").collect())


def decompose(word: str, ranks: dict[str, int], grow: frozenset[str]) -> tuple[list[tuple[int, int, int]], int]:
    """``([(rank, start, end)], bound)``: the grams of the padded word and how many one edit can change."""
    padded = f"^{word}$"
    size, grams = len(padded), []
    for start in range(size - 1):
        end = start + SHORT_GRAM
        while end < size and padded[start:end] in grow:
            end += 1
        grams.append((ranks[padded[start:end]], start, end))
    over = [0] * (size + 1)
    for _, start, end in grams:
        over[start] += 1
        over[end] -= 1
    bound = running = over[0]
    for place in range(1, size):
        running += over[place]
        bound = max(bound, running)
    return grams, bound


def near_pairs(words: DataFrame, *, least_length: int = LEAST_LENGTH, longest: int = LONG_GRAM,
               frequent: int = FREQUENT) -> DataFrame:
    """``word, n, other, other_n`` for words that differ by exactly one inserted, deleted or
    replaced code point; each pair stands in both directions.

    ``words`` has distinct words of ``least_length`` code points or more, and their ``n``. Grams are
    no longer than the shortest word, so every word has more grams than one edit can change.
    """
    longest = max(SHORT_GRAM, min(longest, least_length))
    words = words.select("word", "n").filter(F.length("word") >= least_length)
    shared = words.sparkSession.sparkContext.broadcast(gram_dictionary(words, longest=longest, frequent=frequent))

    def of(batches):
        ranks, grow = shared.value
        for batch in batches:
            at, parts = [], []
            for row, word in enumerate(batch.column(0).to_pylist()):
                padded = f"^{word}$"
                grams, bound = decompose(word, ranks, grow)
                for _, start, end in sorted(grams)[:bound + 1]:
                    at += [row, row]
                    parts += [f"<{padded[:end]}", f">{padded[start:]}"]
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(parts, pa.string())],
                                             names=["word", "n", "part"])

    listed = written(words.mapInArrow(of, "word string, n long, part string").select(
        F.xxhash64("part").alias("part"), "word", F.length("word").alias("size"), "n"), "gram-lists")
    a, b = listed.alias("a"), listed.alias("b")
    alike = (F.abs(F.col("a.size") - F.col("b.size")) <= 1) & (F.col("a.word") < F.col("b.word"))
    pairs = a.join(b, (F.col("a.part") == F.col("b.part")) & alike & (F.levenshtein("a.word", "b.word", 1) == 1)).select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("other"), F.col("b.n").alias("other_n")).distinct()
    return pairs.select(F.explode(F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")),
    )).alias("p")).select("p.*")


def group_variants(words: DataFrame, **how) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each ``word, n``.

    The form is the near word of largest n (ties: the first in code-point order) if that is at
    least twice the word's; the root is where forms lead to, after doubling steps. An empty table
    gives an empty table.
    """
    words = written(words.select("word", "n"), "words")
    near = near_pairs(words, **how).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("least"), "other")).alias("best"))
    strong = -F.col("best.least") >= 2 * F.col("n")
    forms = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.least")).alias("form_n")), "forms")
    roots = forms.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("above"))
        roots = written(roots.select("word", "root").join(up, "root").select(
            "word", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "roots")
        if roots.filter("moved").isEmpty():
            break
    return forms.join(roots.select("word", "root"), "word").select("word", "form", "root", "n", "n_near", "form_n")


@query("op13_spelling_variants")
def op13(spark, folder):
    return group_variants(count_words(table(spark, folder, "documents")))
