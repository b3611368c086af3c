"""Feature, split, sampling, TF-IDF and scaling queries."""

from pyspark.sql import functions as F

from ..functions import style
from ..functions.constants import CLUSTER_FEATURES, NUMERIC_FEATURES
from ..functions.state import cut_lineage
from ..operators import features, scaling, split, tfidf
from . import corpus as corpus_queries
from . import sqltext as q
from .registry import Tables, query

_ALL = (*NUMERIC_FEATURES, "numeric_digit_ratio", "is_first_sent", "is_last_sent")


def rounded_entropy(df):
    """Logarithms may differ in the last bits between engines; everything else is exact."""
    return df.withColumn("char_entropy", F.round("char_entropy", 6))


def sql_rounded(names) -> str:
    return ", ".join("round(char_entropy, 6) AS char_entropy" if n == "char_entropy" else n for n in names)


@query("features_sentence", f"""SELECT doc_id, sent_id, cast(doc_id AS VARCHAR) || ':' || cast(sent_id AS VARCHAR) AS sample_id,
    {sql_rounded(_ALL)} FROM {q.features(q.sentences('documents', 'doc_id'), 'doc_id, sent_id', _ALL, pos='sent_id', total='total')}""")
def features_sentence(t: Tables):
    from ..operators.corpus import with_sample_id

    table = features.sentence_features(t.documents.select("doc_id", "text")).drop("text")
    return rounded_entropy(with_sample_id(table)).select("doc_id", "sent_id", "sample_id", *_ALL)


_CLEAN_DOCS = f"(SELECT * FROM (SELECT doc_id, {q.collapse('text')} AS text FROM documents) WHERE regexp_matches(text, '{q.W}'))"


@query("features_document", f"""SELECT doc_id, {sql_rounded(NUMERIC_FEATURES)}
    FROM {q.features(_CLEAN_DOCS, 'doc_id', NUMERIC_FEATURES)}""")
def features_document(t: Tables):
    return rounded_entropy(features.document_features(t.documents.select("doc_id", "text"))).select(
        "doc_id", *NUMERIC_FEATURES)


@query("wordless_documents", f"""SELECT doc_id FROM (
    SELECT doc_id, CASE lang WHEN 'de' THEN regexp_replace(text, '{q.W}', '-', 'g') ELSE text END AS text FROM documents)
    WHERE NOT regexp_matches({q.collapse('text')}, '{q.W}')""")
def wordless_documents(t: Tables):
    blanked = F.when(F.col("lang") == "de", F.regexp_replace("text", q.W, "-")).otherwise(F.col("text"))
    return features.wordless_documents(
        t.documents.select("doc_id", blanked.alias("text"))).select("doc_id")


@query("features_rounded", f"""SELECT * FROM {q.features(q.sentences('documents', 'doc_id'), 'doc_id, sent_id',
    NUMERIC_FEATURES, pos='sent_id', total='total', stored=True)}""")
def features_rounded(t: Tables):
    rows = t.sentences(labelled=False)
    return style.stylometry(
        rows, position=F.col("sent_id"), total=F.col("total"), rounded=True
    ).select("doc_id", "sent_id", *NUMERIC_FEATURES)


_SURVIVORS = f"({corpus_queries._SURVIVORS})"


@query("doc_pos_repair", f"""WITH s AS {_SURVIVORS}, l AS (SELECT doc_id, max(sent_id) AS last_sent FROM s GROUP BY doc_id)
  SELECT doc_id, sent_id, avg_word_len, sent_id / greatest(last_sent, 1) AS doc_pos
  FROM {q.features('(SELECT * FROM s JOIN l USING (doc_id))', 'doc_id, sent_id, last_sent', ('avg_word_len',))}""")
def doc_pos_repair(t: Tables):
    """Stored columns are wrong on purpose; the repair ignores them."""
    from ..operators.corpus import drop_sentence_overlap

    rows = drop_sentence_overlap(t.sentences().drop("total"))
    stored = rows.withColumns({"avg_word_len": F.lit(999.0), "doc_pos": F.lit(-1.0)})
    return features.repair_features(stored).select("doc_id", "sent_id", "avg_word_len", "doc_pos")


@query("missing_feature_fill", f"""WITH s AS (SELECT * FROM {q.LABELLED_SENTENCES}),
    l AS (SELECT doc_id, max(sent_id) AS last_sent FROM s GROUP BY doc_id)
  SELECT doc_id, sent_id, 7 AS word_count, {sql_rounded([n for n in NUMERIC_FEATURES if n not in ('word_count', 'doc_pos')])},
    sent_id / greatest(last_sent, 1) AS doc_pos
  FROM {q.features('(SELECT * FROM s JOIN l USING (doc_id))', 'doc_id, sent_id, last_sent',
                   [n for n in NUMERIC_FEATURES if n != 'doc_pos'])}""")
def missing_feature_fill(t: Tables):
    """A stored word count is kept; the absent features are computed."""
    stored = t.sentences().drop("total").withColumn("word_count", F.lit(7))
    return rounded_entropy(features.repair_features(stored)).select("doc_id", "sent_id", *NUMERIC_FEATURES)


LEXICON = ("the ", "tion", "der ", "ing of", "que", "heit", "est, ", "an and")


@query("ai_tells_lexicon", f"""SELECT doc_id, {q.formula('ai_tell_count', LEXICON)} AS ai_tell_count,
    {q.formula('ai_tell_count')} AS standard_count FROM (
    SELECT doc_id, text || CASE lang WHEN 'en' THEN ' A Testament to it, moreover.' ELSE '' END AS text FROM documents)""")
def ai_tells_lexicon(t: Tables):
    tail = F.when(F.col("lang") == "en", " A Testament to it, moreover.").otherwise("")
    lowered = F.lower(F.concat("text", tail))
    return t.documents.select(
        "doc_id", style.tell_count(lowered, LEXICON).alias("ai_tell_count"),
        style.tell_count(lowered).alias("standard_count"))


# ---- Splits and samples ----------------------------------------------------------

def sql_split(key: str) -> str:
    u = f"({q.hash_key(key)}) / 4294967296.0::DOUBLE"
    return f"CASE WHEN {u} < 0.15 THEN 'test' WHEN {u} < 0.3 THEN 'validation' ELSE 'train' END"


@query("split_documents", f"SELECT doc_id, sent_id, {sql_split('doc_id')} AS split FROM {q.LABELLED_SENTENCES}")
def split_documents(t: Tables):
    return split.split_documents(t.sentences()).select("doc_id", "sent_id", "split")


def _sql_quota(source: str, size: str, share: str, out: str) -> str:
    return f"""(SELECT * EXCLUDE (w, e, r, k), floor(e)::BIGINT + CASE WHEN r <= k THEN 1 ELSE 0 END AS {out} FROM (
      SELECT *, row_number() OVER (ORDER BY e - floor(e) DESC, label DESC) AS r, w - sum(floor(e)) OVER () AS k FROM (
      SELECT *, w * {size} / sum({size}) OVER () AS e FROM (
      SELECT *, ceil(round(sum({size}) OVER () * {share}::DOUBLE, 6)) AS w FROM {source}))))"""


def sql_exact_split(documents: str) -> str:
    """``doc_id, label, split`` of ``documents (doc_id, label)``."""
    return f"""WITH d AS (SELECT doc_id, label, {q.hash_key('doc_id')} AS k FROM {documents}),
  sizes AS (SELECT label, count(*) AS n FROM d GROUP BY label),
  t AS (SELECT *, n - n_test AS rest FROM {_sql_quota('sizes', 'n', '0.15', 'n_test')}),
  v AS (SELECT * FROM {_sql_quota('t', 'rest', '(0.15::DOUBLE / 0.85::DOUBLE)', 'n_validation')})
  SELECT doc_id, d.label, CASE WHEN row_number() OVER (PARTITION BY d.label ORDER BY k, doc_id) <= n_test THEN 'test'
    WHEN row_number() OVER (PARTITION BY d.label ORDER BY k, doc_id) <= n_test + n_validation THEN 'validation'
    ELSE 'train' END AS split FROM d JOIN v ON d.label = v.label"""


@query("split_exact", sql_exact_split("(SELECT doc_id, quality AS label FROM documents JOIN labels USING (doc_id))"))
def split_exact(t: Tables):
    return split.exact_split(t.labelled()).select("doc_id", "label", "split")


@query("split_summary", f"""SELECT split, count(*) AS rows, count(DISTINCT doc_id) AS documents
    FROM (SELECT doc_id, {sql_split('doc_id')} AS split FROM {q.LABELLED_SENTENCES}) GROUP BY split""")
def split_summary(t: Tables):
    return split.split_summary(split.split_documents(t.sentences()))


@query("split_leakage", f"""SELECT doc_id, min(split) AS first_split, max(split) AS last_split FROM (
    SELECT doc_id, {sql_split("doc_id || ':' || sent_id")} AS split FROM {q.LABELLED_SENTENCES})
    GROUP BY doc_id HAVING min(split) <> max(split)""")
def split_leakage(t: Tables):
    """A split by sentence leaks; the check names the documents."""
    leaky = t.sentences().withColumn("split", split.hash_split(F.concat_ws(
        ":", F.col("doc_id").cast("string"), F.col("sent_id").cast("string"))))
    return split.split_leaks(leaky)


@query("sample_hash", f"""SELECT doc_id, sent_id FROM {q.sentences('documents', 'doc_id')}
    ORDER BY {q.hash_key("doc_id || ':' || sent_id")}, doc_id, sent_id LIMIT 30000""")
def sample_hash(t: Tables):
    return split.sample_rows(
        t.sentences(labelled=False), n=30_000, keys=["doc_id", "sent_id"]).select("doc_id", "sent_id")


@query("examples_per_group", f"""SELECT source, doc_id, example FROM (SELECT source, doc_id,
    row_number() OVER (PARTITION BY source ORDER BY {q.hash_key('doc_id')}, doc_id) AS example FROM documents)
    WHERE example <= 5""")
def examples_per_group(t: Tables):
    return split.examples_per_group(t.documents, group="source", keys=["doc_id"]).select(
        "source", "doc_id", "example")


# ---- TF-IDF and scaling ------------------------------------------------------------

TOKENS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')"
TFIDF = f"""tokens AS (SELECT doc_id AS sample_id, {TOKENS} AS tk FROM documents),
  counts AS (SELECT sample_id, term, count(*) AS tf FROM (
    SELECT sample_id, unnest(tk || list_transform(range(1, len(tk)), lambda i: tk[i] || ' ' || tk[i + 1])) AS term FROM tokens)
    GROUP BY sample_id, term),
  vocab AS (SELECT *, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM (
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS total FROM counts GROUP BY term)
    WHERE df >= 2 AND df <= 0.98 * (SELECT count(*) FROM documents) ORDER BY total DESC, term LIMIT 20000),
  raw AS (SELECT sample_id, term, (1 + ln(tf)) * idf AS w FROM counts JOIN vocab USING (term)),
  weights AS (SELECT sample_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY sample_id)) AS weight FROM raw)"""


def _samples(t: Tables):
    return t.documents.select(F.col("doc_id").alias("sample_id"), "text")


@query("tfidf_vocab", f"WITH {TFIDF} SELECT term, df, total, round(idf, 6) AS idf FROM vocab")
def tfidf_vocab(t: Tables):
    vocab, _ = tfidf.tfidf(_samples(t))
    return vocab.withColumn("idf", F.round("idf", 6))


@query("tfidf_weights", f"WITH {TFIDF} SELECT sample_id, term, round(weight, 6) AS weight FROM weights")
def tfidf_weights(t: Tables):
    _, weights = tfidf.tfidf(_samples(t))
    return weights.withColumn("weight", F.round("weight", 6))


_DOCS8 = q.features(_CLEAN_DOCS, "doc_id", CLUSTER_FEATURES)


def document_table(t: Tables, columns=CLUSTER_FEATURES):
    """Document features, computed once for jobs that read them several times."""
    return cut_lineage(features.document_features(
        t.documents.select("doc_id", "text"), features=columns).select("doc_id", *columns))


_GAPPED = f"""(SELECT doc_id, CASE WHEN semicolon_dash_count = 0 THEN NULL ELSE char_entropy END AS char_entropy,
    CASE WHEN rep_bigram > 0.5 THEN NULL ELSE rep_bigram END AS rep_bigram,
    CASE WHEN avg_word_len > 5 THEN NULL ELSE avg_word_len END AS avg_word_len FROM {_DOCS8})"""


@query("impute_median", f"""SELECT doc_id, {', '.join(
    f"round(coalesce({c}, (SELECT median({c}::DOUBLE) FROM g)), 6) AS {c}"
    for c in ('char_entropy', 'rep_bigram', 'avg_word_len'))} FROM g""".replace("SELECT doc_id", f"WITH g AS {_GAPPED} SELECT doc_id", 1))
def impute_median(t: Tables):
    gapped = document_table(t).select(
        "doc_id",
        F.when(F.col("semicolon_dash_count") != 0, F.col("char_entropy")).alias("char_entropy"),
        F.when(F.col("rep_bigram") <= 0.5, F.col("rep_bigram")).alias("rep_bigram"),
        F.when(F.col("avg_word_len") <= 5, F.col("avg_word_len")).alias("avg_word_len"))
    columns = ["char_entropy", "rep_bigram", "avg_word_len"]
    filled = scaling.impute_median(gapped, columns)
    return filled.select("doc_id", *[F.round(c, 6).alias(c) for c in columns])


def _sql_scaled(centre: bool) -> str:
    cols = ", ".join(
        f"round(({c}{f' - (SELECT avg({c}) FROM g)' if centre else ''}) / "
        f"(SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM g), 6) AS {c}"
        for c in CLUSTER_FEATURES)
    return f"WITH g AS {_DOCS8} SELECT doc_id, {cols} FROM g"


@query("scale_population", _sql_scaled(False))
def scale_population(t: Tables):
    scaled = scaling.scale(document_table(t), CLUSTER_FEATURES)
    return scaled.select("doc_id", *[F.round(c, 6).alias(c) for c in CLUSTER_FEATURES])


@query("standardise", _sql_scaled(True))
def standardise(t: Tables):
    scaled = scaling.standardise(document_table(t), CLUSTER_FEATURES)
    return scaled.select("doc_id", *[F.round(c, 6).alias(c) for c in CLUSTER_FEATURES])
