"""Quotation linking: who quotes whom, and conversations in reply order without quotes.

Lines that begin with ``>`` are quotes, each further ``>`` is a level. Runs of lines with one level
are passages. A passage links to the earliest message before it in the conversation whose own words
are, or hold as a line, the same normalised words; where there is none, to the earliest that holds
its lines in a row. Both sides meet by hash. DataFrame functions only.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import query, table, written

_MARKS = "^((?:[ \\t]*>)+)[ \\t]?"
_PASSAGE = ["conv_id", "turn", "th", "level", "at"]


def normalised(text: Column) -> Column:
    """Lower case, single blanks, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), "\\s+", " "))


def key_of(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def own_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~x.rlike(_MARKS))


def passages(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, th, level, at, passage, key`` of each quoted run of lines with words."""
    quoting = messages.filter(F.col("text").rlike("(?m)^[ \\t]*>")).select("conv_id", "turn", "th", "text").distinct()
    lines = quoting.select("conv_id", "turn", "th", F.posexplode(F.split("text", "\n")).alias("at", "line")).select(
        "conv_id", "turn", "th", "at", F.length(F.regexp_replace(F.regexp_extract("line", _MARKS, 1), "[ \\t]", "")).alias("level"),
        F.regexp_replace("line", _MARKS, "").alias("line"))
    message = Window.partitionBy("conv_id", "turn", "th").orderBy("at")
    runs = lines.withColumn("new", F.coalesce(F.lag("level").over(message) != F.col("level"), F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(message)).filter("level > 0")
    whole = runs.groupBy("conv_id", "turn", "th", "level", "run").agg(
        F.min("at").alias("at"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x.line), "\n").alias("passage"))
    return whole.withColumn("key", key_of(F.col("passage"))).filter(normalised(F.col("passage")) != "").drop("run")


def units(messages: DataFrame) -> DataFrame:
    """``conv_id, key, origin``: earliest message with these words as its own text or an own line."""
    own = messages.select("conv_id", "turn", own_lines(F.col("text")).alias("lines"))
    parts = own.select("conv_id", "turn", F.explode(F.array_union("lines", F.array(F.array_join("lines", "\n")))).alias("part"))
    return parts.filter(normalised(F.col("part")) != "").select(
        "conv_id", key_of(F.col("part")).alias("key"), "turn").groupBy("conv_id", "key").agg(F.min("turn").alias("origin"))


def runs(messages: DataFrame, lengths: DataFrame) -> DataFrame:
    """``conv_id, key, origin``: earliest message with these words as a run of its own lines with words.

    ``lengths`` has the numbers ``n`` of lines to try in each ``conv_id``; a run is a part of its message.
    """
    lines = F.filter(F.transform(own_lines(F.col("text")), normalised), lambda x: x != "")
    own = messages.select("conv_id", "turn", lines.alias("lines")).filter(F.size("lines") > 2)
    own = own.join(lengths, "conv_id").filter(F.size("lines") > F.col("n"))
    keys = F.transform(F.sequence(F.lit(1), F.size("lines") - F.col("n") + 1),
                       lambda k: F.sha2(F.array_join(F.slice("lines", k, F.col("n")), " ").cast("binary"), 256))
    return own.select("conv_id", "turn", F.explode(keys).alias("key")).groupBy("conv_id", "key").agg(F.min("turn").alias("origin"))


def _earliest(quoted: DataFrame, origins: DataFrame) -> DataFrame:
    return quoted.join(origins, ["conv_id", "key"]).filter("origin < turn").groupBy(*_PASSAGE).agg(F.min("origin").alias("origin"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, own_text, n_quotes, n_linked, parent_turn, root_turn, depth``.

    One row for each row of ``messages`` (conv_id, turn, role, text, any others). The parent is the
    original of the linked passage with the lowest level, the earliest in the text of those; then
    the smallest turn. Ordered by (conv_id, root_turn, turn) every message follows what it replies to;
    a message without a linked quote begins a thread, with depth 0. ``own_text`` lacks the quoted
    lines and outer white space; null text stays null. Rows without conv_id or turn link with
    nothing. Messages that repeat a turn are each linked; a turn has the parent of its smallest one.
    """
    rows = messages.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("th"))
    quoted = written(passages(rows), "passages")
    here = units(rows.join(quoted.select("conv_id").distinct(), "conv_id", "left_semi"))
    links = written(_earliest(quoted, here), "links")
    n = F.size(F.filter(F.split("passage", "\n"), lambda x: normalised(x) != ""))
    open_ = written(quoted.join(links, _PASSAGE, "left_anti").withColumn("n", n).filter("n > 1"), "open-passages")
    links = links.union(_earliest(open_, runs(rows, open_.select("conv_id", "n").distinct())))
    told = quoted.join(links, _PASSAGE, "left").groupBy("conv_id", "turn", "th").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("origin").alias("n_linked"),
        F.min(F.when(F.col("origin").isNotNull(), F.struct("level", "at", "origin"))).alias("best"))
    told = told.select("conv_id", "turn", "th", "n_quotes", "n_linked", F.col("best.origin").alias("parent_turn"))
    told = written(told, "quotes")
    up = told.filter("parent_turn is not null").groupBy("conv_id", "turn").agg(F.min("parent_turn").alias("up")).withColumn("steps", F.lit(1))
    up = written(up, "parents")
    while True:  # pointer doubling: rounds grow with the logarithm of the depth
        next_ = up.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("far"), F.col("steps").alias("more"))
        moved = up.join(next_, ["conv_id", "up"], "left")
        if moved.filter("far is not null").isEmpty():
            break
        up = written(moved.select("conv_id", "turn", F.coalesce("far", "up").alias("up"),
                                  (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "parents")
    roots = up.select("conv_id", "turn", F.col("up").alias("root_turn"), F.col("steps").alias("depth"))
    out = rows.join(told, ["conv_id", "turn", "th"], "left").join(roots, ["conv_id", "turn"], "left")
    own = F.when(F.col("text").isNotNull(), F.btrim(F.array_join(own_lines(F.col("text")), "\n"), F.lit(" \t\n\r")))
    return out.select(
        "conv_id", "turn", "role", "text", own.alias("own_text"), F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))


_SQL = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, text, string_split(coalesce(text, ''), chr(10)) AS l FROM conversations),
x AS (SELECT conv_id, turn, unnest(l) AS line, unnest(range(len(l))) AS pos FROM m),
y AS (
  SELECT conv_id, turn, pos, length(replace(replace(regexp_extract(line, '^((?:[ \t]*>)+)', 1), ' ', ''), chr(9), '')) AS level,
    regexp_replace(line, '^((?:[ \t]*>)+)[ \t]?', '') AS line FROM x
),
z AS (
  SELECT *, pos - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY pos) AS run FROM y
),
p AS (
  SELECT conv_id, turn, level, min(pos) AS pos, trim(regexp_replace(lower(string_agg(line, chr(10) ORDER BY pos)), '\s+', ' ', 'g')) AS k
  FROM z WHERE level > 0 GROUP BY conv_id, turn, level, run HAVING k <> ''
),
o AS (SELECT conv_id, turn, string_agg(line, chr(10) ORDER BY pos) AS own FROM y WHERE level = 0 GROUP BY conv_id, turn),
u AS (
  SELECT conv_id, turn, trim(regexp_replace(lower(own), '\s+', ' ', 'g')) AS k FROM o
  UNION SELECT conv_id, turn, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) FROM y WHERE level = 0
),
f AS (
  SELECT p.conv_id, p.turn, p.level, p.pos, min(u.turn) AS origin
  FROM p LEFT JOIN u ON p.conv_id = u.conv_id AND p.k = u.k AND u.turn < p.turn GROUP BY ALL
),
q AS (
  SELECT conv_id, turn, count(*) AS n_quotes, count(origin) AS n_linked,
    arg_min(origin, level * 1000000 + pos) FILTER (origin IS NOT NULL) AS parent_turn FROM f GROUP BY conv_id, turn
),
r AS (
  SELECT conv_id, turn, turn AS root_turn, 0 AS depth FROM m WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM q WHERE parent_turn IS NOT NULL)
  UNION ALL SELECT q.conv_id, q.turn, r.root_turn, r.depth + 1 FROM q JOIN r ON q.conv_id = r.conv_id AND q.parent_turn = r.turn
)
SELECT m.conv_id, m.turn, m.role, m.text,
  CASE WHEN m.text IS NULL THEN NULL ELSE trim(coalesce(o.own, ''), ' ' || chr(9) || chr(10) || chr(13)) END AS own_text,
  coalesce(q.n_quotes, 0)::BIGINT AS n_quotes, coalesce(q.n_linked, 0)::BIGINT AS n_linked, q.parent_turn,
  r.root_turn, r.depth::BIGINT AS depth
FROM m LEFT JOIN o USING (conv_id, turn) LEFT JOIN q USING (conv_id, turn) LEFT JOIN r USING (conv_id, turn)
"""


@query("op2_quotation_links", _SQL)
def op2(spark, folder):
    return link_quotes(table(spark, folder, "conversations"))
