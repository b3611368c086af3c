"""Language ID by words first: known words score by their log frequency in each language, unseen
words by that of their letter n-grams, from the longest known length down to single letters.

The model is fitted on a bounded sample of labelled rows, whose tokens Spark counts. Prediction is
one pass over the texts with the model broadcast; its size is that of the sample's vocabulary.
"""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import query, table

#: Labelled rows to fit on, about, for each language; drawn by a hash of id and text.
SAMPLE_ROWS = 2000
LONGEST = 4
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
#: Least share of a token, so that one odd word does not decide; unseen words whose scores a task keeps.
FLOOR, CACHE = 1e-7, 300_000


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 modulo 3; a null id is none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _tokens(longest: int):
    def of(batches):
        for batch in batches:
            counts: dict[tuple, int] = defaultdict(int)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in _WORD.findall((text or "").lower()):
                    counts[lang, word] += 1
            out: dict[tuple, int] = defaultdict(int)
            for (lang, word), n in counts.items():
                out[lang, 0, word] += n
                padded = f" {word} "
                for size in range(1, longest + 1):
                    for k in range(len(padded) - size + 1):
                        out[lang, size, padded[k:k + size]] += n
            keys = list(out)
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2] for k in keys], pa.string()), pa.array(list(out.values()), pa.int64())],
                names=["lang", "size", "token", "n"])
    return of


class LanguageModel:
    """Log frequencies of words and n-grams by language, less their mean over languages.

    ``places`` has for each length (0: whole words) the row of a token in ``weights``, a matrix with
    a column for each language; the rows of words come first.
    """

    def __init__(self, langs: list[str], places: list[dict[str, int]], weights: np.ndarray):
        self.langs, self.places, self.weights = langs, places, weights

    def weigh(self, word: str) -> np.ndarray:
        """Score of one word for each language."""
        known = self.places[0].get(word)
        if known is not None:
            return self.weights[known]
        padded, rows = f" {word} ", []
        for k in range(len(padded)):
            for size in range(min(len(self.places) - 1, len(padded) - k), 0, -1):
                found = self.places[size].get(padded[k:k + size])
                if found is not None:
                    rows.append(found)
                    break
        return self.weights[rows].mean(axis=0) if rows else np.zeros(len(self.langs))

    def predict(self, texts):
        """``(language, score, known)`` of each text: the score is the posterior of the best language,
        ``known`` the share of its words that the model was fitted on."""
        known = len(self.places[0]) if self.places else 0
        rows = number = matrix = None
        for text in texts:
            found = _WORD.findall(text.lower()) if text else []
            if not self.langs or not (any(map(str.isalpha, found)) or any(c.isalpha() for w in found for c in w)):
                yield UNKNOWN, 0.0, 0.0
                continue
            if rows is None or number > known + CACHE:
                # Known words have their row already; scores of unseen ones are added behind them.
                rows, number, matrix = dict(self.places[0]), known, self.weights[:known]
            try:
                at = [rows[w] for w in found]
            except KeyError:
                unseen = [w for w in dict.fromkeys(found) if w not in rows]
                if number + len(unseen) > len(matrix):
                    room = np.empty((number + len(unseen) + len(matrix) // 4 + 1024, len(self.langs)))
                    room[:number] = matrix[:number]
                    matrix = room
                for word in unseen:
                    matrix[number] = self.weigh(word)
                    rows[word] = number
                    number += 1
                at = [rows[w] for w in found]
            at = np.array(at)
            total = matrix[at].sum(axis=0)
            best = int(np.argmax(total))
            yield self.langs[best], float(1 / np.exp(total - total[best]).sum()), float((at < known).mean())


def fit(labelled: DataFrame, *, draw: Column | None = None, sample_rows: int = SAMPLE_ROWS,
        longest: int = LONGEST) -> LanguageModel:
    """Fit on (text, lang) of about ``sample_rows`` rows a language, all of fewer; every word and
    n-gram of the sample is kept, so the sample bounds the model.

    ``draw`` is a hash that decides which rows; give one that tells copies apart (default: of the text).
    Rows without text or language are left out. No labelled row gives a model without languages,
    which calls every text unknown.
    """
    rows = labelled.filter("lang is not null and text is not null").select(
        "lang", "text", (F.xxhash64("text") if draw is None else draw).alias("draw"))
    totals = {r.lang: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return LanguageModel([], [], np.zeros((0, 0)))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample_rows / n))) for k, n in totals.items()])
    sample = rows.filter(F.pmod("draw", F.lit(1 << 20)) < share * (1 << 20))
    counts = sample.select("lang", "text").mapInArrow(_tokens(longest), "lang string, size int, token string, n long").groupBy(
        "lang", "size", "token").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    langs = sorted(totals)
    counts["share"] = counts["n"] / counts.groupby(["lang", "size"])["n"].transform("sum")
    kinds = counts[["size", "token"]].drop_duplicates().sort_values(["size", "token"], ignore_index=True)
    places = [dict(zip(part["token"], part.index)) for _, part in (
        (k, kinds[kinds["size"] == k]) for k in range(longest + 1))]
    weights = np.full((len(kinds), len(langs)), FLOOR)
    at = [places[size][token] for size, token in zip(counts["size"], counts["token"])]
    weights[at, counts["lang"].map(langs.index)] = np.maximum(counts["share"], FLOOR)
    weights = np.log(weights)
    return LanguageModel(langs, places, weights - weights.mean(axis=1, keepdims=True))


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text", lang: str = "lang_pred",
             score: str = "lang_score", known: str | None = None) -> DataFrame:
    """``docs`` with two columns more: the language and its posterior, 0 to 1; and, if a name is given
    for it, the share of words that are ``known``. The posterior nears 1 with the length of any
    text; the share does not, and tells languages that were never learnt.

    Null texts and texts without a letter are ``und`` with 0. Equal scores go to the language that
    sorts first. Whole texts are read. An empty table gives none.
    """
    names = [lang, score, *([known] if known else [])]
    if set(names) & set(docs.columns):
        raise ValueError(f"docs already has one of the columns {names}; choose other names")
    out = docs.withColumns({lang: F.lit(""), **{n: F.lit(0.0) for n in names[1:]}})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches):
        own = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            found = list(own.predict(t.as_py() for t in texts))
            added = [pa.array([f[k] for f in found], pa.float64() if k else pa.string()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(batch.num_columns - len(names))), *added], names=batch.schema.names)

    return out.mapInArrow(of, out.schema)


@query("op9_language_id")
def op9(spark, folder):
    docs = table(spark, folder, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"))), draw=F.xxhash64("doc_id", "text"))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
