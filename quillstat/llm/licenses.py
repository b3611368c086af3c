"""License scans by a positional word index; DataFrame functions only.

The index holds, for each word of the license templates, the templates and positions where it
stands. For each template a file looks up its words of highest IDF, as many as leave less than a
label needs; their postings, at equal distance, name starts of the template. The IDF of all words
found in place against that of the whole template is the score, and a label needs half of it. The
key phrase is verified last. Files without a label look up their other words too, for their score.
Document frequencies count all documents.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, query, table, written

#: Base phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Template: (label, text, mandatory phrase), in normalised words.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)
#: Words that the SQL looks up in a file, by IDF, and the share of a template's IDF that labels.
LOOKUPS, SHARE = 8, 0.5
#: What separates words, as a Java class; all characters beyond ASCII belong to words.
_GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def index_rows(templates=TEMPLATES) -> list[tuple[int, str, int]]:
    """``(template, word, position)``."""
    return [(t, w, k) for t, (_, text, _) in enumerate(templates) for k, w in enumerate(text.split())]


def _values(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A constant table, as SQL, so that it needs no Python."""
    text = ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {text} AS t({', '.join(names)})")


def _count(text: Column, phrase: str) -> Column:
    """Places of a phrase in normalised text with a blank at either end; neighbours share a blank."""
    return F.regexp_count(text, F.lit(f"(?<= ){phrase}(?= )"))


def _words_before(text: Column, end: Column) -> Column:
    head = F.substring(text, F.lit(1), end)
    return (F.length(head) - F.length(F.replace(head, F.lit(" "), F.lit(""))) - 1).cast("long")


def scan(docs: DataFrame, *, keys: tuple[str, ...] = ("doc_id",), templates=TEMPLATES, share: float = SHARE) -> DataFrame:
    """``keys, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    Null text is empty. A-Z are lower-cased; other letters only where that makes no ASCII letter.
    ``score`` is the largest share of a template's IDF that a text holds in place, 0 without any, rounded
    to 6 places; ties need no rule. Repeated rows each give a row; an empty table none. ``keys`` must
    not be called like the columns above.
    """
    spark = docs.sparkSession
    safe = F.coalesce(F.col("text"), F.lit(""))
    phrases = [key.split() for _, _, key in templates]
    names = sorted({w for _, w, _ in index_rows(templates)} | {w for p in (*phrases, *map(str.split, PHRASES)) for w in p})
    vocabulary = F.array(*map(F.lit, names))
    words = F.split(F.lower(safe), _GAPS)

    def holds(phrase: list[str]) -> Column:
        return F.size(F.array_except(F.array(*map(F.lit, phrase)), "_known")) == 0

    rows = docs.select(*keys, safe.alias("_safe"), words.alias("_words")).select(
        F.monotonically_increasing_id().alias("_row"), *keys, "_words",
        F.size(F.array_remove("_words", "")).cast("long").alias("n_words"),
        F.array_intersect("_words", vocabulary).alias("_known"))
    # texts are kept where all words of a base phrase or of a template's key phrase stand anywhere
    wanted = reduce(Column.__or__, [holds(p) for p in (*phrases, *map(str.split, PHRASES))])
    rows = rows.withColumn("_flat", F.when(wanted, F.concat(F.lit(" "), F.btrim(F.array_join("_words", " ")), F.lit(" ")))).drop("_words")
    rows = written(rows, "license-rows")
    total = rows.count()
    frequency = rows.select(F.explode("_known").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    index = _values(spark, index_rows(templates), ["template", "word", "position"])
    idf = F.round(F.log(F.lit(1.0 + total) / (1.0 + F.coalesce("df", F.lit(0)))) + 1, 6)
    index = written(index.join(frequency, "word", "left").select("template", "word", "position", idf.alias("idf")), "license-index")
    weights = index.groupBy("template").agg(F.sum("idf").alias("whole"))
    texts = _values(spark, [(t, label, len(text.split()), f" {key} ") for t, (label, text, key) in enumerate(templates)],
                    ["template", "label", "n", "key"])
    possible = F.array_compact(F.array(*[F.when(holds(p), F.lit(t)) for t, p in enumerate(phrases)]))
    held = rows.filter("_flat is not null").select("_row", "_known", "_flat", possible.alias("_templates")).filter(F.size("_templates") > 0)
    found = held.select("_row", "_known", F.posexplode(F.split(F.btrim("_flat"), " ")).alias("at", "word")).filter(
        F.array_contains("_known", F.col("word"))).drop("_known")
    # a file's words of each template by IDF; what is left from a word on, itself included
    known = held.select("_row", "_known", F.explode("_templates").alias("template")).select(
        "_row", "template", F.explode("_known").alias("word"))
    gains = index.groupBy("template", "word").agg(F.max("idf").alias("idf"), F.sum("idf").alias("gain"))
    onward = Window.partitionBy("_row", "template").orderBy("idf", F.desc("word")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = known.join(F.broadcast(gains), ["template", "word"]).withColumn("_left", F.sum("gain").over(onward)).join(
        F.broadcast(weights), "template")
    ranked = written(ranked.select("_row", "template", "word", (F.col("_left") >= F.col("whole") * (share - 1e-6)).alias("rare")), "license-words")
    rare = _placed(ranked.filter("rare"), index, weights, texts, found, held).filter(F.col("score") >= share)
    rare = written(rare, "license-labels")
    rest = ranked.join(rare.select("_row").distinct(), "_row", "left_anti")
    scored = rare.unionByName(_placed(rest, index, weights, texts, found, held))
    return _finish(rows, scored, keys, share)


def _placed(looked_up, index, weights, texts, found, held):
    """``_row, label, score`` of the starts of templates that the looked-up words name and that hold the key phrase."""
    starts = looked_up.select("_row", "template", "word").join(found, ["_row", "word"]).join(
        F.broadcast(index.drop("idf")), ["template", "word"]).select(
        "_row", "template", (F.col("at") - F.col("position")).alias("start")).distinct()
    expected = starts.join(F.broadcast(index), "template").select(
        "_row", "template", "start", "word", "idf", (F.col("start") + F.col("position")).alias("at"))
    hits = expected.join(found, ["_row", "at", "word"]).groupBy("_row", "template", "start").agg(F.sum("idf").alias("part"))
    first = F.greatest("start", F.lit(0))
    window = F.slice(F.split(F.btrim("_flat"), " "), first + 1, F.col("start") + F.col("n") - first)
    phrase = F.contains(F.concat(F.lit(" "), F.array_join(window, " "), F.lit(" ")), F.col("key"))
    return hits.join(F.broadcast(weights), "template").join(F.broadcast(texts), "template").join(
        held.select("_row", "_flat"), "_row").filter(phrase).select(
        "_row", "label", F.round(F.col("part") / F.col("whole"), 6).alias("score"))


def _finish(rows, scored, keys, share):
    best = scored.groupBy("_row").agg(
        F.max("score").alias("score"), F.collect_set(F.when(F.col("score") >= share, F.col("label"))).alias("_more"))
    text, base = F.col("_flat"), {p: _count(F.col("_flat"), p) for p in PHRASES}
    first = F.least(*[F.when(F.locate(f" {p} ", text) > 0, F.locate(f" {p} ", text)) for p in PHRASES])
    turned = F.reverse(text)
    last = F.greatest(*[F.when(F.locate(f" {p} ", text) > 0, F.length(text) - F.locate(f" {p} "[::-1], turned) - len(p)) for p in PHRASES])
    named = F.array_distinct(F.array_compact(F.array(*[F.when(base[p] > 0, F.lit(label)) for p, label in PHRASES.items()])))
    out = rows.filter("_flat is not null").join(best, "_row", "left").select(
        *keys, "n_words", F.coalesce(sum(base.values()), F.lit(0)).cast("long").alias("n_base"),
        _words_before(text, first).alias("first_word"), _words_before(text, last).alias("last_word"),
        F.array_sort(named).alias("_base"), F.coalesce("_more", F.array().cast("array<string>")).alias("_more"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
    out = out.select(*keys, "n_words", "n_base", "first_word", "last_word", F.array_join("_base", ",").alias("base_labels"),
                     F.array_join(F.array_sort(F.array_union("_base", "_more")), ",").alias("labels"), "score")
    none = rows.filter("_flat is null").select(
        *keys, "n_words", F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"),
        F.lit(None).cast("long").alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"))
    return out.unionByName(none)


_SPLIT = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_SQL = f"""
WITH t(template, label, body, key) AS (VALUES {", ".join(str((t, *row)) for t, row in enumerate(TEMPLATES))}),
b(phrase, label) AS (VALUES {", ".join(map(str, PHRASES.items()))}),
p AS (SELECT template, unnest(string_split(body, ' ')) AS word, unnest(range(len(string_split(body, ' ')))) AS position FROM t),
d AS (SELECT row_number() OVER () AS r, doc_id, {_SPLIT} AS w FROM documents),
x AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS at_ FROM d),
y AS (SELECT * FROM x WHERE word IN (SELECT word FROM p)),
f AS (SELECT word, count(DISTINCT r) AS df FROM y GROUP BY word),
g AS (
  SELECT p.*, round(ln((1.0::DOUBLE + (SELECT count(*) FROM d)) / (1.0::DOUBLE + coalesce(df, 0))) + 1, 6) AS idf
  FROM p LEFT JOIN f ON p.word = f.word
),
whole AS (SELECT template, sum(idf) AS whole FROM g GROUP BY template),
c AS (
  SELECT r, word FROM (SELECT DISTINCT r, y.word, idf FROM y JOIN g ON y.word = g.word)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY idf DESC, word) <= {LOOKUPS}
),
s AS (
  SELECT DISTINCT y.r, template, at_ - position AS start FROM y JOIN c ON y.r = c.r AND y.word = c.word JOIN g ON y.word = g.word
),
h AS (
  SELECT s.r, s.template, s.start, sum(g.idf) AS part
  FROM s JOIN g ON s.template = g.template JOIN y ON y.r = s.r AND y.word = g.word AND y.at_ = s.start + g.position GROUP BY ALL
),
v AS (
  SELECT h.r, t.label, round(part / whole, 6) AS score
  FROM h JOIN whole ON h.template = whole.template JOIN t ON h.template = t.template JOIN d ON h.r = d.r
  WHERE contains(' ' || array_to_string(w[greatest(start, 0) + 1:start + len(string_split(body, ' '))], ' ') || ' ', ' ' || key || ' ')
),
m AS (SELECT r, max(score) AS score FROM v GROUP BY r),
k AS (
  SELECT r, at_, label, phrase FROM x JOIN b ON x.word = string_split(phrase, ' ')[1] JOIN d USING (r)
  WHERE array_to_string(w[at_ + 1:at_ + len(string_split(phrase, ' '))], ' ') = phrase
),
n AS (SELECT r, count(*) AS n_base, min(at_) AS lo, max(at_) AS hi FROM k GROUP BY r),
bl AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT r, label FROM k) GROUP BY r),
al AS (
  SELECT r, string_agg(label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM k UNION SELECT r, label FROM v WHERE score >= {SHARE}) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, lo AS first_word, hi AS last_word,
  coalesce(bl.labels, '') AS base_labels, coalesce(al.labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN bl ON d.r = bl.r LEFT JOIN al ON d.r = al.r LEFT JOIN m ON d.r = m.r
"""


@query("op5_license_scan", _SQL)
def op5(spark, folder):
    return scan(table(spark, folder, "documents"))
