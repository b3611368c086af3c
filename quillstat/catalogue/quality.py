"""Constraint and admission queries."""

from pyspark.sql import functions as F

from ..operators import corpus, quality
from . import sqltext as q
from .corpus import ROLES
from .registry import Tables, query

_ROLE = "CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 END"
_TURNS = f"""(SELECT conv_id AS doc_id, turn AS sent_id, CASE turn WHEN 3 THEN ' ' ELSE text END AS text,
    {_ROLE} AS label, role AS source,
    CASE role WHEN 'system' THEN 'n/a' ELSE cast(length(text) AS VARCHAR) END AS size_note,
    CASE turn WHEN 0 THEN 'Infinity' ELSE '1.5' END AS ratio_note FROM conversations)"""


def _turns(t: Tables):
    rows = t.conversations.select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("sent_id"),
        F.when(F.col("turn") == 3, " ").otherwise(F.col("text")).alias("text"),
        F.col("role").alias("label"), F.col("role").alias("source"),
        F.when(F.col("role") == "system", "n/a").otherwise(F.length("text").cast("string")).alias("size_note"),
        F.when(F.col("turn") == 0, "Infinity").otherwise("1.5").alias("ratio_note"))
    return corpus.map_corpus_labels(rows, mapping=ROLES)


@query("dq_report", f"""WITH c AS (SELECT * FROM {_TURNS}),
  d AS (SELECT doc_id, min(label) AS lo, max(label) AS hi, min(source) AS a, max(source) AS b FROM c GROUP BY doc_id)
  SELECT * FROM (VALUES
    ('empty_text', (SELECT count(*) FROM c WHERE NOT regexp_matches(text, '{q.NOT_WS}'))),
    ('unsupported_label', (SELECT count(*) FROM c WHERE label IS NULL)),
    ('bad_feature', (SELECT count(*) FROM c WHERE try_cast(size_note AS DOUBLE) IS NULL)),
    ('infinite_feature', (SELECT count(*) FROM c WHERE ratio_note = 'Infinity')),
    ('duplicate_key', (SELECT count(*) FROM (SELECT 1 FROM c GROUP BY doc_id, sent_id HAVING count(*) > 1))),
    ('duplicate_sample_id', (SELECT count(*) FROM (SELECT 1 FROM c GROUP BY doc_id, sent_id HAVING count(*) > 1))),
    ('mixed_label', (SELECT count(*) FROM d WHERE lo <> hi)),
    ('mixed_source', (SELECT count(*) FROM d WHERE a <> b)),
    ('thin_class', (SELECT (count(*) FILTER (lo = 0) < 4)::BIGINT + (count(*) FILTER (lo = 1) < 4)::BIGINT FROM d))
  ) v("constraint", violations)""")
def dq_report(t: Tables):
    return quality.quality_report(_turns(t), features=("size_note", "ratio_note"))


@query("dq_empty_texts", f"SELECT doc_id, sent_id FROM {_TURNS} WHERE NOT regexp_matches(text, '{q.NOT_WS}')")
def dq_empty_texts(t: Tables):
    return quality.empty_texts(_turns(t)).select("doc_id", "sent_id")


@query("dq_duplicate_keys", """SELECT source, lang, count(*) AS rows FROM documents
    GROUP BY source, lang HAVING count(*) > 1""")
def dq_duplicate_keys(t: Tables):
    return quality.duplicate_keys(t.documents, ("source", "lang"))


@query("dq_mixed_documents", f"""SELECT * FROM (SELECT doc_id, min(label) <> max(label) AS mixed_label,
    min(source) <> max(source) AS mixed_source FROM {_TURNS} GROUP BY doc_id)
    WHERE mixed_label OR mixed_source""")
def dq_mixed_documents(t: Tables):
    return quality.mixed_documents(_turns(t))


@query("dq_class_documents", f"""SELECT label, count(*) AS documents FROM (
    SELECT doc_id, min(label) AS label FROM {_TURNS} GROUP BY doc_id) GROUP BY label""")
def dq_class_documents(t: Tables):
    return quality.class_documents(_turns(t))


@query("dq_coerced_features", f"""SELECT doc_id, sent_id, try_cast(size_note AS DOUBLE) AS size_note,
    CASE WHEN NOT isinf(try_cast(ratio_note AS DOUBLE)) THEN try_cast(ratio_note AS DOUBLE) END AS finite_ratio,
    coalesce(isinf(try_cast(ratio_note AS DOUBLE)), false) AS infinite FROM {_TURNS}""")
def dq_coerced_features(t: Tables):
    """All rows; an infinite ratio is flagged, since the comparison has no value for it."""
    infinite = F.coalesce(F.abs("ratio_note") == float("inf"), F.lit(False))
    return quality.coerce_features(_turns(t), features=("size_note", "ratio_note")).select(
        "doc_id", "sent_id", "size_note", F.when(~infinite, F.col("ratio_note")).alias("finite_ratio"), infinite.alias("infinite"))


# Real texts, plus rows derived from them that break the remaining rules.
_REQUESTS = """(SELECT 'd' || doc_id AS request, text FROM documents
  UNION ALL SELECT 'c' || conv_id || ':' || turn, text FROM conversations
  UNION ALL SELECT 'p' || page_id, html FROM pages
  UNION ALL SELECT 'x' || doc_id, text || chr(7) FROM documents
  UNION ALL SELECT 'n' || doc_id, regexp_replace(text, '[\\p{L}\\p{N}_]', '.', 'g') FROM documents
  UNION ALL SELECT 'e' || doc_id, regexp_replace(text, '[^ ]', ' ', 'g') FROM documents)"""
_CODE = f"""CASE WHEN text IS NULL OR NOT regexp_matches(text, '{q.NOT_WS}') THEN 'EMPTY_TEXT'
  WHEN length(text) > 10000 OR strlen(text) > 40000 THEN 'TEXT_TOO_LARGE'
  WHEN length({q.strip('text')}) < 20 THEN 'TEXT_TOO_SHORT'
  WHEN regexp_matches(text, '{q.CONTROL_IN}') THEN 'UNSAFE_CONTROL_CHARACTER'
  WHEN len(p) = 0 THEN 'NO_WORDS' WHEN len(p) > 100 THEN 'TOO_MANY_SENTENCES' END"""
_CODED = f"""(SELECT request, {_CODE} AS reject_code FROM (
    SELECT *, {q.sentence_list(q.collapse('text'))} AS p FROM {_REQUESTS}))"""


def _requests(t: Tables):
    def rows(df, key, text):
        return df.select(key.alias("request"), text.alias("text"))

    docs, text = t.documents, F.col("text")

    def key(letter, column="doc_id"):
        return F.concat(F.lit(letter), F.col(column).cast("string"))

    union = rows(docs, key("d"), text)
    for other in (
        rows(t.conversations, F.concat_ws(":", key("c", "conv_id"), F.col("turn").cast("string")), text),
        rows(t.pages, key("p", "page_id"), F.col("html")),
        rows(docs, key("x"), F.concat(text, F.lit("\u0007"))),
        rows(docs, key("n"), F.regexp_replace(text, r"[\p{L}\p{N}_]", ".")),
        rows(docs, key("e"), F.regexp_replace(text, "[^ ]", " ")),
    ):
        union = union.unionByName(other)
    return union


@query("admission_codes", f"SELECT request, reject_code FROM {_CODED}")
def admission_codes(t: Tables):
    return quality.admit(_requests(t)).select("request", "reject_code")


@query("quarantine_counts", f"""SELECT reject_code, count(*) AS rows FROM {_CODED}
    WHERE reject_code IS NOT NULL GROUP BY reject_code""")
def quarantine_counts(t: Tables):
    return quality.quarantined(quality.admit(_requests(t))).groupBy("reject_code").agg(
        F.count(F.lit(1)).alias("rows"))


@query("accepted_texts", f"SELECT request FROM {_CODED} WHERE reject_code IS NULL")
def accepted_texts(t: Tables):
    return quality.accepted(quality.admit(_requests(t))).select("request")
