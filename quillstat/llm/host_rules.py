"""Host-level quality rules: rates of rule failures by host, shrunk by an empirical beta prior.

Everything is DataFrame functions. Repeated three-word windows are found inside the row: window
hashes packed with their places are sorted as numbers, and neighbours with equal hashes are
compared by their words. Texts are never shuffled, only counts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, query, table, written

WHITE = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A host whose shrunk failure rate exceeds this fails with all its documents.
MAX_HOST_RATE = 0.5
#: Bits of a packed number that hold the place of a word: texts of up to 67 million words.
_PLACE = 26


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Null text counts as empty. Words are runs of other characters than ASCII white space; a line
    counts as repeated if it has a word and equals an earlier line; a word as repeated if it stands
    in a window of three words that occurs twice or more. Columns with these names are replaced.
    """
    own = [c for c in docs.columns if c not in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    safe = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(safe, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{BLANKS}]+"))
    lines = F.filter(F.split(safe, "\n"), lambda x: x.rlike(f"[^{BLANKS}]"))
    out = docs.select(*own, words.alias("_words"), F.regexp_count(safe, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                      lines.alias("_lines"))
    out = out.select(*own, "_words", "n_symbols", F.size("_words").cast("long").alias("n_words"),
                     F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
                     (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    high = F.lit(-(1 << _PLACE)).cast("long")

    def packed(i: Column) -> Column:
        return F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).bitwiseAND(high).bitwiseOR(i.cast("long"))

    windows = F.when(F.col("n_words") >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3), packed))).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("_windows", windows)

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << _PLACE) - 1).cast("long")).cast("int")

    def equal(x: Column, y: Column) -> Column:
        same = F.shiftright(x, _PLACE) == F.shiftright(y, _PLACE)
        for k in range(3):
            same = same & (F.get("_words", place(x) + k) == F.get("_words", place(y) + k))
        return F.coalesce(same, F.lit(False))

    again = F.filter("_windows", lambda x, i: equal(x, F.get("_windows", i + 1)) | equal(x, F.get("_windows", i - 1)))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.sequence(place(x), place(x) + 2))))
    return out.select(*own, "n_words", "word_chars", "n_symbols", "n_dup_lines", F.size(covered).cast("long").alias("n_repeat_words"))


def host_verdicts(rows: DataFrame, *, host: str, failed: str, limit: float = MAX_HOST_RATE) -> DataFrame:
    """``host, host_rows, host_rate, host_failed``; one row a host, null being one host.

    The prior is a beta distribution with the mean and the variance between hosts of the failure
    rates, less what binomial chance explains; without variance left all rates shrink to the mean.
    """
    hosts = rows.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_rows"), F.sum(F.col(failed).cast("long")).alias("fails"))
    hosts = hosts.withColumn("rate", F.col("fails") / F.col("host_rows"))
    mean, spread, chance = hosts.agg(
        F.sum("fails") / F.sum("host_rows"), F.var_pop("rate"), F.avg(1 / F.col("host_rows"))).first()
    mean = mean or 0.0
    between = (spread or 0.0) - mean * (1 - mean) * (chance or 0.0)
    weight = min(1e6, max(1.0, mean * (1 - mean) / between - 1)) if between > 0 else 1e6
    rate = (F.col("fails") + F.lit(mean * weight)) / (F.col("host_rows") + F.lit(weight))
    return hosts.select("host", "host_rows", rate.alias("host_rate"), (rate > limit).alias("host_failed"))


def quality_verdicts(docs: DataFrame, *, host: str = "source", keys: tuple[str, ...] = ("doc_id",),
                     limit: float = MAX_HOST_RATE) -> DataFrame:
    """``keys``, the counts, ``base_failed``, ``host_rate`` and ``kept`` of every row.

    A row fails by itself with fewer than 50 words or with more than half of them repeated; the
    others are dropped with a host that fails. An empty table gives none.
    """
    rows = text_counts(docs.select(*keys, F.col(host).alias("host"), "text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = written(rows.drop("text").withColumn("base_failed", failed), "counts")
    hosts = host_verdicts(rows, host="host", failed="base_failed", limit=limit)
    own = rows.withColumnRenamed("host", "own")
    out = own.join(hosts, F.col("own").eqNullSafe(F.col("host")))
    return out.select(*keys, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "host_rate", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"))


_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS x FROM documents
), a AS (
  SELECT r, doc_id, source, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w,
    length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM t
), g AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS v
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM a)
), d AS (
  SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, v) > 1
), p AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM d) GROUP BY r
), c AS (
  SELECT a.r, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    n_symbols::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM a LEFT JOIN p ON a.r = p.r
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
), h AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k, k / n AS rate FROM f GROUP BY source
), m AS (
  SELECT sum(k) / sum(n) AS mean, var_pop(rate) - mean * (1 - mean) * avg(1 / n) AS between_ FROM h
), q AS (
  SELECT mean, CASE WHEN between_ > 0 THEN least(1e6, greatest(1, mean * (1 - mean) / between_ - 1)) ELSE 1e6 END AS weight FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ((k + mean * weight) / (n + weight) > 0.5) AS kept
FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source CROSS JOIN q
"""


@query("op10_host_rules", _SQL)
def op10(spark, folder):
    return quality_verdicts(table(spark, folder, "documents")).drop("host_rate")
