"""Exploratory queries over labelled sentence features, and request summaries."""

from itertools import product

from pyspark.sql import functions as F

from ..functions import style
from ..functions.constants import HISTOGRAM_FEATURES, NUMERIC_FEATURES
from ..functions.state import cut_lineage
from ..operators import corpus, explore
from . import sqltext as q
from .registry import Tables, query

_TABLE = q.features(q.LABELLED_SENTENCES, "doc_id, label, source, prompt", NUMERIC_FEATURES,
                    pos="sent_id", total="total")


def table(t: Tables, columns=NUMERIC_FEATURES):
    return style.stylometry(
        t.sentences(), position=F.col("sent_id"), total=F.col("total"), features=columns)


def stored_table(t: Tables, columns=NUMERIC_FEATURES):
    """The feature table as a job of several passes would read it: computed once."""
    return cut_lineage(table(t, columns).select("label", *columns))


def _long(columns=NUMERIC_FEATURES) -> str:
    return f"""(SELECT label, unnest([{', '.join(f"'{c}'" for c in columns)}]) AS feature,
      unnest([{', '.join(f'{c}::DOUBLE' for c in columns)}]) AS value FROM f)"""


@query("class_balance", f"""SELECT label, count(*) AS rows, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent
    FROM {q.LABELLED_SENTENCES} GROUP BY label""")
def class_balance(t: Tables):
    return explore.class_balance(t.sentences())


# The first slice: cleaned, valid, distinct documents; sentence features by class.
_SLICE = f"""WITH clean AS (SELECT doc_id, label, text FROM {q.chain(q.LABELLED, 'doc_id, label')} WHERE NOT {q.invalid('text')}
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
  f AS (SELECT * FROM {q.features(q.sentences('clean', 'doc_id, label'), 'doc_id, label', NUMERIC_FEATURES, pos='sent_id', total='total')})"""
_SUMMARY = f"""SELECT feature AS features, round(avg(value) FILTER (label = 0), 6) AS human_mean, round(avg(value) FILTER (label = 1), 6) AS ai_mean,
    round(stddev_samp(value) FILTER (label = 0), 6) AS human_std, round(stddev_samp(value) FILTER (label = 1), 6) AS ai_std,
    round(avg(value) FILTER (label = 1) - avg(value) FILTER (label = 0), 6) AS diff,
    round(abs(avg(value) FILTER (label = 1) - avg(value) FILTER (label = 0)), 6) AS abs_diff FROM {_long()} GROUP BY feature"""


def _rounded(frame, places=6):
    return frame.withColumns({c: F.round(c, places) for c in frame.columns if c != "features"})


@query("corpus_style_by_class", f"{_SLICE} {_SUMMARY}")
def corpus_style_by_class(t: Tables):
    from ..operators import cleaning
    from ..operators.sentences import split_runtime

    clean = cleaning.drop_invalid(cleaning.clean_corpus(t.labelled().select("doc_id", "label", "text")))
    distinct = corpus.keep_first(clean, order=["doc_id"])
    rows = style.stylometry(
        split_runtime(distinct, clean=False), position=F.col("sent_id"), total=F.col("total"))
    return _rounded(explore.feature_summary(rows, places=None))


@query("feature_summary", f"WITH f AS {_TABLE} {_SUMMARY}")
def feature_summary(t: Tables):
    return _rounded(explore.feature_summary(table(t), places=None))


_CAPS = f"caps AS (SELECT feature, quantile_cont(value, 0.99) AS upper FROM {_long()} GROUP BY feature)"


@query("quantile_cap", f"WITH f AS {_TABLE}, {_CAPS} SELECT feature, round(upper, 6) AS upper FROM caps")
def quantile_cap(t: Tables):
    return explore.quantile_caps(table(t)).withColumn("upper", F.round("upper", 6))


def _capped(columns) -> str:
    return f"""capped AS (SELECT label, feature, value FROM {_long(columns)} JOIN caps USING (feature) WHERE value <= upper)"""


@query("capped_counts", f"""WITH f AS {_TABLE}, {_CAPS}, {_capped(NUMERIC_FEATURES)}
    SELECT feature, label, count(*) AS rows FROM capped GROUP BY feature, label""")
def capped_counts(t: Tables):
    return explore.capped_values(stored_table(t)).groupBy("feature", "label").agg(
        F.count(F.lit(1)).alias("rows"))


@query("density_histogram", f"""WITH f AS (SELECT label, {', '.join('round(char_entropy, 9) AS char_entropy' if c == 'char_entropy' else c
      for c in HISTOGRAM_FEATURES)} FROM {_TABLE}), {_CAPS.replace(_long(), _long(HISTOGRAM_FEATURES))}, {_capped(HISTOGRAM_FEATURES)},
  spans AS (SELECT feature, label, count(*) AS n, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
    CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM capped GROUP BY feature, label),
  binned AS (SELECT feature, label, n, lo, hi, least(floor((value - lo) / (hi - lo) * 40), 39)::INT AS bin FROM capped JOIN spans USING (feature, label))
  SELECT feature, label, bin, count(*) AS rows, round(lo + bin * ((hi - lo) / 40), 6) AS bin_start,
    round(count(*) / (n * ((hi - lo) / 40)), 6) AS density FROM binned GROUP BY feature, label, bin, n, lo, hi""")
def density_histogram(t: Tables):
    # Entropies that are equal on paper must fall into the same bin in both engines.
    rows = table(t, HISTOGRAM_FEATURES).withColumn("char_entropy", F.round("char_entropy", 9))
    return explore.density_histogram(rows).withColumns(
        {c: F.round(c, 6) for c in ("bin_start", "density")})


def _corr_rows() -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, " + (
            f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0::DOUBLE END" if a == b else f"corr({a}, {b})"
        ) + " AS r FROM f" for a, b in product(NUMERIC_FEATURES, repeat=2))
    return f"SELECT feature_a, feature_b, CASE WHEN isnan(r) THEN NULL ELSE round(r, 2) END AS r FROM ({cells})"


@query("correlation", f"WITH f AS MATERIALIZED (SELECT * FROM {_TABLE}) {_corr_rows()}")
def correlation(t: Tables):
    return explore.correlation_matrix(table(t))


BOX_STATISTICS = f"""WITH f AS {_TABLE}, {_CAPS}, {_capped(NUMERIC_FEATURES)},
  qs AS (SELECT feature, label, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
    FROM capped GROUP BY feature, label)
  SELECT feature, label, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
    round(least(min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)), q1), 6) AS whisker_low,
    round(greatest(max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)), q3), 6) AS whisker_high, count(*) AS rows
  FROM capped JOIN qs USING (feature, label) GROUP BY feature, label, q1, median, q3"""


@query("box_stats", BOX_STATISTICS)
def box_stats(t: Tables):
    stats = explore.box_statistics(table(t))
    return stats.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


@query("length_summary", f"""SELECT min(c) AS min, round(avg(c), 6) AS mean, max(c) AS max, median(c)::DOUBLE AS median
    FROM (SELECT length(text) AS c FROM {q.sentences('documents', 'doc_id')})""")
def length_summary(t: Tables):
    rows = t.sentences(labelled=False).select(F.length("text").alias("char_count"))
    return explore.length_summary(rows).withColumn("mean", F.round("mean", 6))


_KINDS = ("click", "error", "purchase", "signup", "view")


@query("request_rollup", f"""SELECT dayofweek(ts) + 1 AS mode, count(*) AS total_requests,
    {', '.join(f"count(*) FILTER (event_type = '{k}') AS status_{k}" for k in _KINDS)},
    round(avg(value), 6) AS mean_response, max(value) AS maximum_response, round(median(value), 6) AS median_response
    FROM events GROUP BY ALL""")
def request_rollup(t: Tables):
    log = t.events.withColumn("mode", F.dayofweek("ts"))
    summary = explore.request_summary(
        log, mode="mode", status="event_type", elapsed="value", statuses=_KINDS)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean_response", "median_response")})


@query("group_summary", f"""SELECT source, label, count(*) AS rows, count(DISTINCT doc_id) AS documents
    FROM {q.LABELLED_SENTENCES} GROUP BY source, label""")
def group_summary(t: Tables):
    return explore.group_summary(t.sentences())


@query("group_rollup", f"""SELECT prompt, label, count(*) AS rows, count(DISTINCT doc_id) AS documents
    FROM {q.LABELLED_SENTENCES} GROUP BY ROLLUP (prompt, label)""")
def group_rollup(t: Tables):
    return explore.group_summary(t.sentences(), groups=("prompt", "label"), subtotals=True)
