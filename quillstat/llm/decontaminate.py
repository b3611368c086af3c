"""Benchmark decontamination: one Aho-Corasick automaton over normalised windows of the test items.

Each text is scanned once. Hits are word spans, mapped back to characters of the original text.
The automaton is built where it is used, from the items' texts, which are broadcast. An items table
over ITEM_BYTES is cut into blocks of about that size, one automaton and one scan each.
"""

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, query, table

WINDOW = 10
#: Most bytes of item texts in one automaton, and so in one broadcast.
ITEM_BYTES = 16 << 20
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SPAN = "struct<item_id: string, first_word: int, last_word: int, begin: int, end: int>"
_SPAN = pa.struct([("item_id", pa.string()), *((n, pa.int32()) for n in ("first_word", "last_word", "begin", "end"))])


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased words; all bytes beyond ASCII are letters of words."""
    return raw.translate(_KEEP).split()


def automaton(items: list[tuple[str, str]], window: int):
    """Automaton whose values are ``(length, item ids)``, over words with a space on either side."""
    owners: dict[str, dict[str, None]] = {}
    for item, text in items:
        found = words_of((text or "").encode())
        for k in range(max(1, len(found) - window + 1) if found else 0):
            key = " " + b" ".join(found[k:k + window]).decode("latin-1") + " "
            owners.setdefault(key, {})[item] = None
    out = ahocorasick.Automaton()
    for key, own in owners.items():
        out.add_word(key, (len(key), key.count(" ") - 1, tuple(own)))
    if owners:
        out.make_automaton()
    return out if owners else None


def text_spans(machine, raw: bytes) -> tuple[int, list[tuple]]:
    """Number of words, and ``(item, first word, last word, begin, end)`` of each hit, ends exclusive."""
    found = words_of(raw)
    if machine is None or not found:
        return len(found), []
    flat = " " + b" ".join(found).decode("latin-1") + " "
    hits, counted, at = [], 0, 0
    for end, (length, size, owners) in sorted(machine.iter(flat), key=lambda h: h[0] - h[1][0]):
        start = end - length + 1
        counted += flat.count(" ", at, start)
        at = start
        hits += [(item, counted, counted + size - 1) for item in owners]
    if not hits:
        return len(found), []
    places = [m.span() for m in _WORD.finditer(raw)]
    chars: dict[int, int] = {}
    last = done = 0
    for byte in sorted({places[h[1]][0] for h in hits} | {places[h[2]][1] for h in hits}):
        done += len(raw[last:byte].decode())
        last = byte
        chars[byte] = done
    return len(found), [(i, a, b, chars[places[a][0]], chars[places[b][1]]) for i, a, b in hits]


def _scan(items: list[tuple[str, str]], window: int, text: str):
    def of(batches):
        machine = automaton(items, window)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            before = batch.column(batch.num_columns - 1)
            counts, spans = [], []
            for k, value in enumerate(texts):
                number, hits = text_spans(machine, (value.as_py() or "").encode())
                counts.append(number)
                spans.append((before[k].as_py() or []) + [
                    dict(zip(("item_id", "first_word", "last_word", "begin", "end"), h)) for h in hits])
            columns = [batch.column(k) for k in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int64()), pa.array(spans, pa.list_(_SPAN))], names=batch.schema.names)
    return of


def find_leaks(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, text: str = "text",
               spans: str = "leak_spans", words: str = "leak_words") -> DataFrame:
    """``docs`` with all its columns, the number of words and the spans where items stand.

    A window is ``window`` consecutive words of an item (item_id, text, any others); an item with
    fewer words, but not none, is one window. Null or wordless items have none; items that repeat
    count once by id. A null item_id reads as "". Null or empty texts have no words and no spans.
    Existing columns named as the new ones must be renamed by the caller through ``spans``, ``words``.
    """
    spark = docs.sparkSession
    if {spans, words} & set(docs.columns):
        raise ValueError(f"docs already has a column {spans} or {words}; choose other names")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // ITEM_BYTES))
    out = docs.withColumns({words: F.lit(0).cast("long"), spans: F.lit(None).cast(f"array<{SPAN}>")})
    fields = out.schema
    narrow = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), "text")
    for block in range(blocks):
        rows = narrow.filter(F.pmod(F.xxhash64("i", "text"), F.lit(blocks)) == block).collect()
        out = out.mapInArrow(_scan([(r.i, r.text) for r in rows], window, text), fields)
    return out


def hit_words(spans):
    """Number of words inside any span, as a column."""
    return F.size(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s.first_word, s.last_word))))).cast("long")


_SPLIT = (f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_SQL = f"""
WITH i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_SPLIT} AS w FROM benchmark),
v AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS v
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
),
s AS (SELECT DISTINCT n FROM v),
d AS (SELECT row_number() OVER () AS r, doc_id, {_SPLIT} AS w FROM documents),
x AS (
  SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS v
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d JOIN s ON len(w) >= n)
),
h AS (SELECT r, k, x.n, item FROM x JOIN v ON x.n = v.n AND x.v = v.v),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM h) GROUP BY r),
o AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN o ON d.r = o.r
"""


@query("op8_decontaminate", _SQL)
def op8(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    item = F.array_sort(F.array_distinct(F.transform("leak_spans", lambda s: s.item_id)))
    return found.select(
        "doc_id", F.col("leak_words").alias("n_words"), hit_words(F.col("leak_spans")).alias("n_hit"),
        F.size(item).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", item).cast("binary"), 256).alias("items_sha256"),
        (F.size("leak_spans") > 0).alias("contaminated"))
