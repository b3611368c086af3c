"""Cleaning, normalising, sentence and token queries."""

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import cleaning, robustness, sentences
from . import sqltext as q
from .registry import Tables, query


@query("clean_chain_docs", f"SELECT doc_id, text FROM {q.chain('documents', 'doc_id')}")
def clean_chain_docs(t: Tables):
    return cleaning.clean_corpus(t.documents.select("doc_id", "text"))


_URL_TEXT = "text || ' see https://a.b/c?d=' || doc_id || ' and www.x.y now'"


@query("clean_url_injected", f"""SELECT doc_id, text FROM {q.chain(
    f"(SELECT doc_id, {_URL_TEXT} AS text FROM documents)", 'doc_id')}""")
def clean_url_injected(t: Tables):
    return cleaning.clean_corpus(t.documents.select("doc_id", F.expr(_URL_TEXT).alias("text")))


_DASH_TEXT = "'-----' || text || ' ===== a -- b ______' || doc_id"


@query("clean_dash_injected", f"""SELECT doc_id, text FROM {q.chain(
    f"(SELECT doc_id, {_DASH_TEXT} AS text FROM documents)", 'doc_id')}""")
def clean_dash_injected(t: Tables):
    return cleaning.clean_corpus(t.documents.select("doc_id", F.expr(_DASH_TEXT).alias("text")))


@query("clean_stutter_injected", f"""SELECT doc_id, text FROM {q.chain('documents', 'doc_id')}""")
def clean_stutter_injected(t: Tables):
    """Stutter runs put before and after every text vanish again."""
    stuttered = F.concat(F.lit("s-S-s-s-s-s-s "), F.col("text"), F.lit(" x-x-x-x-x-x-x"))
    return cleaning.clean_corpus(t.documents.select("doc_id", stuttered.alias("text")))


@query("clean_stage_audit", f"""
    SELECT count(*) AS rows_in,
      count(*) FILTER (text IS NULL OR length(s5) = 0) AS rows_missing,
      count(*) FILTER (text <> s1) AS rows_clean_changed, count(*) FILTER (s1 <> s2) AS rows_url_changed,
      count(*) FILTER (s2 <> s3) AS rows_blob_changed, 0 AS rows_stutter_changed,
      count(*) FILTER (s3 <> s5) AS rows_dash_changed,
      count(*) FILTER (length(s5) > 0 AND {q.invalid('s5')}) AS rows_invalid,
      count(*) FILTER (length(s5) > 0 AND NOT {q.invalid('s5')}) AS rows_valid
    FROM (SELECT *, {q.dashes('s3')} AS s5 FROM (SELECT *, {q.blobs('s2')} AS s3 FROM (
      SELECT *, {q.urls('s1')} AS s2 FROM (SELECT text, {q.collapse('text')} AS s1 FROM documents))))""")
def clean_stage_audit(t: Tables):
    return cleaning.cleaning_audit(t.documents.select("text"))


@query("invalid_filter", f"""SELECT doc_id, length(text) AS chars FROM {q.chain('documents', 'doc_id')}
    WHERE NOT {q.invalid('text')}""")
def invalid_filter(t: Tables):
    cleaned = cleaning.clean_corpus(t.documents.select("doc_id", "text"))
    return cleaning.drop_invalid(cleaned).select("doc_id", F.length("text").alias("chars"))


@query("missing_filter", f"""SELECT doc_id, label FROM {q.CORPUS}
    WHERE text IS NOT NULL AND label IS NOT NULL AND regexp_matches(text, '{q.NOT_WS}')""")
def missing_filter(t: Tables):
    return cleaning.drop_missing(t.corpus()).select("doc_id", "label")


_TAMPERED = "replace(replace(text, 'e', 'е'), '. ', '.' || chr(8203) || chr(160))"


@query("normalise_flag", f"""SELECT doc_id, {q.folded('text')} AS normalised,
    {q.folded('text')} <> {q.strip('text')} AS normalisation_applied
    FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN {_TAMPERED} ELSE text END AS text FROM documents)""")
def normalise_flag(t: Tables):
    tampered = F.expr(_TAMPERED.replace("chr(8203)", "'\u200b'").replace("chr(160)", "'\u00a0'"))
    docs = t.documents.select(
        "doc_id", F.when(F.col("lang") == "en", tampered).otherwise(F.col("text")).alias("text"))
    return cleaning.normalise_for_scoring(docs).drop("text")


@query("normalise_round_trip", f"""SELECT attack, count(*) AS variants,
    count(*) FILTER ({q.folded('attacked')} = {q.folded('text')}) AS restored
    FROM {q.variants('documents', 'doc_id')} GROUP BY attack""")
def normalise_round_trip(t: Tables):
    return robustness.round_trip(t.documents.select("doc_id", "text"))


@query("standardise_text", f"""SELECT doc_id, {q.strip("coalesce(chr(160) || chr(9) || nullif(text, '') || ' ', '')")} AS text
    FROM documents""")
def standardise_text(t: Tables):
    padded = F.concat(F.lit("\u00a0\t"), F.nullif(F.col("text"), F.lit("")), F.lit(" "))
    return cleaning.standardise_text(t.documents.select("doc_id", padded.alias("text")))


@query("sentences_runtime", f"SELECT doc_id, total, sent_id, text FROM {q.sentences('documents', 'doc_id')}")
def sentences_runtime(t: Tables):
    return t.sentences(labelled=False).select("doc_id", "total", "sent_id", "text")


_PADDED = "replace(text, '. ', '. ... ')"


@query("sentences_corpus", f"""SELECT * FROM (
    SELECT doc_id, len(p) AS total, unnest(range(len(p))) AS sent_id, unnest(p) AS text FROM (
      SELECT doc_id, list_filter({q.parts(q.collapse(_PADDED))}, lambda p: p <> '') AS p FROM documents))
    WHERE regexp_matches(text, '{q.W}')""")
def sentences_corpus(t: Tables):
    """Word-less parts are put between sentences, so numbering has gaps."""
    padded = t.documents.select("doc_id", tx.clean_text(F.expr(_PADDED)).alias("text"))
    return sentences.split_corpus(padded)


@query("words_bigrams", f"""SELECT doc_id, len(w) AS words, md5(array_to_string(w, '|')) AS words_md5,
    greatest(len(w) - 1, 0) AS bigrams,
    md5(array_to_string(list_transform(range(1, len(w)), lambda i: lower(w[i]) || ' ' || lower(w[i + 1])), '|')) AS bigrams_md5
    FROM (SELECT doc_id, regexp_extract_all(text, '{q.W}+') AS w FROM documents)""")
def words_bigrams(t: Tables):
    return sentences.words_and_bigrams(t.documents.select("doc_id", "text")).select(
        "doc_id", F.size("words").alias("words"),
        F.md5(F.array_join("words", "|")).alias("words_md5"),
        F.size("bigrams").alias("bigrams"),
        F.md5(F.array_join("bigrams", "|")).alias("bigrams_md5"))


@query("text_counts", f"""SELECT doc_id, length(text) AS characters, strlen(text) AS bytes,
    len(list_filter(string_split({q.collapse('text')}, ' '), lambda x: x <> '')) AS whitespace_words,
    len(list_filter({q.parts(q.strip('text'))}, lambda p: p <> '')) AS sentence_count FROM documents""")
def text_counts(t: Tables):
    return sentences.text_counts(t.documents.select("doc_id", "text")).drop("text")


_GLUED = "replace(text, '. ', '.' || chr(8203) || ' ')"


@query("display_aligned", f"""SELECT doc_id, len(a) = len(b) AS aligned,
    unnest(range(len(b))) AS sent_id,
    unnest(CASE WHEN len(a) = len(b) THEN a ELSE b END) AS display
    FROM (SELECT doc_id, {q.sentence_list(q.strip('text'))} AS a,
      {q.sentence_list(q.folded('text'))} AS b
      FROM (SELECT doc_id, CASE WHEN lang = 'fr' THEN {_GLUED} ELSE text END AS text FROM documents))""")
def display_aligned(t: Tables):
    glued = F.replace(F.col("text"), F.lit(". "), F.lit(".\u200b "))
    docs = cleaning.normalise_for_scoring(t.documents.select(
        "doc_id", F.when(F.col("lang") == "fr", glued).otherwise(F.col("text")).alias("text")))
    shown = sentences.display_sentences(docs)
    return shown.select("doc_id", "aligned", F.posexplode("display").alias("sent_id", "display"))
