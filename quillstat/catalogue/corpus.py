"""Label, key, merge and de-duplication queries."""

from pyspark.sql import functions as F

from ..operators import corpus
from ..plans import corpus_build
from ..sources.readers import base_corpus, resolve_columns
from . import sqltext as q
from .registry import Tables, query

ROLES = {"user": 0, "assistant": 1}
_ROLE = "CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 END"


@query("label_map", f"SELECT role AS raw, {_ROLE} AS label, count(*) AS rows FROM conversations GROUP BY ALL")
def label_map(t: Tables):
    rows = t.conversations.select(F.col("role").alias("raw"), F.col("role").alias("label"))
    return corpus.label_audit(
        corpus.map_corpus_labels(rows, mapping=ROLES), raw_col="raw", mapped_col="label")


_SPELLED = """CASE doc_id % 5 WHEN 0 THEN cast(quality AS VARCHAR) || '.0'
  WHEN 1 THEN CASE quality WHEN 1 THEN ' AI ' ELSE 'Human' END
  WHEN 2 THEN CASE quality WHEN 1 THEN 'ai_generated' ELSE 'HUMAN-WRITTEN' END
  WHEN 3 THEN CASE quality WHEN 1 THEN 'machine' ELSE 'real' END
  ELSE cast(quality AS VARCHAR) END"""


@query("loader_labels", f"""SELECT doc_id, raw, label,
    CASE label WHEN 0 THEN 'human' WHEN 1 THEN 'ai' END AS label_name
    FROM (SELECT doc_id, raw, CASE regexp_replace(lower(trim(raw)), '^([01])\\.0$', '\\1')
      WHEN '0' THEN 0 WHEN 'human' THEN 0 WHEN 'human-written' THEN 0 WHEN 'human_written' THEN 0
      WHEN '1' THEN 1 WHEN 'ai' THEN 1 WHEN 'ai-generated' THEN 1 WHEN 'ai_generated' THEN 1 END AS label
      FROM (SELECT doc_id, {_SPELLED} AS raw FROM labels))""")
def loader_labels(t: Tables):
    spelled = t.labels.select("doc_id", F.expr(_SPELLED.replace("VARCHAR", "STRING")).alias("raw"))
    decoded = spelled.withColumn("label", corpus.loader_label(F.col("raw")))
    return decoded.withColumn("label_name", corpus.label_name(F.col("label")))


@query("source_tag", "SELECT doc_id, 'documents' AS source, 'unknown' AS prompt FROM documents")
def source_tag(t: Tables):
    return corpus.tag_source(t.stored_documents()).select("doc_id", "source", "prompt")


@query("base_scan", f"SELECT text, label, source, prompt FROM {q.CORPUS}")
def base_scan(t: Tables):
    return base_corpus(t.corpus().withColumnRenamed("prompt", "prompt_name"))


@query("resolve_columns", "SELECT text, role AS label FROM conversations")
def resolve_extra_columns(t: Tables):
    renamed = t.conversations.select(
        F.col("turn").alias("Category"), F.col("text").alias(" Content "), F.col("role").alias("Author"))
    return resolve_columns(renamed)


_PREPARED = f"""
  base AS (SELECT text, label, source, prompt, doc_id AS row_ord FROM {q.chain(q.CORPUS, 'doc_id, label, source, prompt')}
    WHERE label IS NOT NULL AND text <> '' QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
  turns AS (SELECT text, {_ROLE} AS label, 'conversations' AS source, 'unknown' AS prompt,
      conv_id * 1048576 + turn AS row_ord FROM conversations),
  extra AS (SELECT text, label, source, prompt, row_ord FROM {q.chain('turns', 'label, source, prompt, row_ord')}
    WHERE label IS NOT NULL AND text <> '' QUALIFY row_number() OVER (PARTITION BY text ORDER BY row_ord) = 1),
  merged AS (SELECT * FROM (SELECT *, 0 AS source_rank FROM base UNION ALL SELECT *, 1 FROM extra)
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY source_rank, row_ord) = 1),
  valid AS (SELECT * FROM merged WHERE NOT {q.invalid('text')}),
  numbered AS (SELECT row_number() OVER (ORDER BY source_rank, row_ord) - 1 AS doc_id, text, label, source, prompt FROM valid)"""


def _merged(t: Tables):
    base = corpus_build.prepare_source(t.corpus(), order="doc_id")
    mapped = corpus.map_corpus_labels(t.chats(), mapping=ROLES)
    return corpus_build.merge_sources([base, corpus_build.prepare_source(mapped, order="row_ord")])


@query("corpus_merge", f"WITH {_PREPARED} SELECT text, label, source, prompt FROM valid")
def corpus_merge(t: Tables):
    return _merged(t).select("text", "label", "source", "prompt")


@query("dense_doc_id", f"WITH {_PREPARED} SELECT doc_id, md5(text) AS text_md5, label FROM numbered")
def dense_doc_id(t: Tables):
    return corpus_build.number_documents(_merged(t)).select(
        "doc_id", F.md5("text").alias("text_md5"), "label")


_STORED = ("char_count", "word_count", "avg_word_len", "vocab_div_ratio", "complex_word_ratio",
           "stopword_ratio", "upper_letter_ratio", "semicolon_dash_count", "char_entropy",
           "rep_bigram", "ai_tell_count", "doc_pos")
_CORPUS_SENTENCES = f"""(SELECT * FROM (
    SELECT doc_id, label, source, prompt, len(p) AS total, unnest(range(len(p))) AS sent_id, unnest(p) AS text
    FROM (SELECT *, list_filter({q.parts('text')}, lambda p: p <> '') AS p FROM numbered))
    WHERE regexp_matches(text, '{q.W}'))"""


CORPUS_SENTENCES_SQL = f"""WITH {_PREPARED} SELECT * FROM {q.features(
    _CORPUS_SENTENCES, 'doc_id, label, source, prompt, sent_id, text', _STORED,
    pos='sent_id', total='total', stored=True)}"""


@query("corpus_sentence_table", CORPUS_SENTENCES_SQL)
def corpus_sentence_table(t: Tables):
    return corpus_build.sentence_corpus(corpus_build.number_documents(_merged(t)))


@query("corpus_document_table", f"""WITH {_PREPARED} SELECT * FROM {q.features(
    'numbered', 'doc_id, label, source, prompt, 0 AS sent_id, text', _STORED, stored=True)}""")
def corpus_document_table(t: Tables):
    return corpus_build.document_corpus(corpus_build.number_documents(_merged(t)))


@query("dedup_keep_first", "SELECT doc_id, source FROM documents "
       "QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def dedup_keep_first(t: Tables):
    return corpus.keep_first(t.stored_documents().select("text", "doc_id", "source"), order=["doc_id"]).select(
        "doc_id", "source")


_JOINED = f"""joined AS (SELECT doc_id, string_agg(text, ' ' ORDER BY sent_id) AS body
    FROM {q.sentences('documents', 'doc_id')} GROUP BY doc_id),
  doubles AS (SELECT doc_id FROM joined QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id) > 1)"""


@query("dup_documents", f"WITH {_JOINED} SELECT doc_id FROM doubles")
def dup_documents(t: Tables):
    return corpus.duplicate_documents(corpus.document_fingerprints(t.sentences(labelled=False)))


@query("distinct_document_rows", f"""WITH {_JOINED} SELECT doc_id, count(*) AS rows FROM {q.sentences('documents', 'doc_id')}
    WHERE doc_id NOT IN (SELECT doc_id FROM doubles) GROUP BY doc_id""")
def distinct_document_rows(t: Tables):
    kept = corpus.drop_duplicate_documents(t.sentences(labelled=False))
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))


@query("conflicting_text", f"""SELECT text, count(*) AS rows FROM {q.LABELLED_SENTENCES}
    GROUP BY text HAVING min(label) <> max(label)""")
def conflicting_text(t: Tables):
    return corpus.conflicting_texts(t.sentences())


@query("conflict_free_rows", f"""SELECT doc_id, sent_id FROM {q.LABELLED_SENTENCES} QUALIFY
    min(label) OVER (PARTITION BY text) = max(label) OVER (PARTITION BY text)""")
def conflict_free_rows(t: Tables):
    return corpus.drop_conflicting_texts(t.sentences()).select("doc_id", "sent_id")


_SURVIVORS = f"""SELECT doc_id, label, source, prompt, sent_id, text FROM {q.LABELLED_SENTENCES} QUALIFY
    min(label) OVER (PARTITION BY text) = max(label) OVER (PARTITION BY text)
    AND row_number() OVER (PARTITION BY text ORDER BY doc_id, sent_id) = 1"""


@query("dup_sentences", f"SELECT doc_id, sent_id, text FROM ({_SURVIVORS})")
def dup_sentences(t: Tables):
    return corpus.drop_sentence_overlap(t.sentences()).select("doc_id", "sent_id", "text")


@query("dedup_audit", f"""WITH s AS (SELECT * FROM {q.LABELLED_SENTENCES}),
  joined AS (SELECT doc_id, string_agg(text, ' ' ORDER BY sent_id) AS body FROM s GROUP BY doc_id),
  doubles AS (SELECT doc_id FROM joined QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id) > 1),
  kept AS (SELECT * FROM s WHERE doc_id NOT IN (SELECT doc_id FROM doubles)),
  texts AS (SELECT text, count(*) AS n, min(label) = max(label) AS same, min((doc_id, sent_id))[1] AS first_doc FROM kept GROUP BY text)
  SELECT (SELECT count(*) FROM s) AS original_rows, (SELECT count(*) FROM joined) AS original_documents,
    (SELECT count(*) FROM doubles) AS duplicate_documents_removed,
    coalesce(sum(n) FILTER (NOT same), 0)::BIGINT AS conflicting_sentence_rows_removed,
    coalesce(sum(n - 1) FILTER (same), 0)::BIGINT AS duplicate_sentence_rows_removed,
    count(*) FILTER (same) AS final_rows,
    count(DISTINCT first_doc) FILTER (same) AS final_documents FROM texts""")
def dedup_audit(t: Tables):
    return corpus.dedup_audit(t.sentences())


@query("key_defaults", f"""SELECT coalesce(nullif(source, 'src0'), 'unknown') AS source, 'unknown' AS prompt,
    cast(doc_id AS VARCHAR) || ':' || cast(sent_id AS VARCHAR) AS sample_id FROM {q.LABELLED_SENTENCES}""")
def key_defaults(t: Tables):
    rows = t.sentences().drop("prompt").withColumn("source", F.nullif(F.col("source"), F.lit("src0")))
    return corpus.with_sample_id(corpus.with_defaults(rows)).select("source", "prompt", "sample_id")


@query("key_row_number", "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id, 0 AS sent_id, md5(text) AS text_md5 FROM documents")
def key_row_number(t: Tables):
    """Without an id column, rows are numbered as they stand in the files."""
    return corpus.with_keys(t.stored_documents().drop("doc_id"), id_column=None).select(
        "doc_id", "sent_id", F.md5("text").alias("text_md5"))
