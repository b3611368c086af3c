"""Clustering queries: documents of class 1 by style, and embeddings by centroid."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.constants import CLUSTER_FEATURES
from ..functions.state import cut_lineage
from ..operators import cluster, features
from . import sqltext as q
from .features import document_table
from .registry import Tables, query

_CLASS_DOCS = f"""(SELECT * FROM (SELECT doc_id, label, {q.collapse('text')} AS text FROM {q.LABELLED})
    WHERE regexp_matches(text, '{q.W}') AND label = 1)"""


def _scaled_vector(table: str) -> str:
    z = ", ".join(f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
                  f"ELSE stddev_pop({c}) OVER () END" for c in CLUSTER_FEATURES)
    return f"(SELECT doc_id AS pid, [{z}]::DOUBLE[] AS vec FROM {table})"


PTS = f"pts AS {_scaled_vector(q.features(_CLASS_DOCS, 'doc_id', CLUSTER_FEATURES))}"
EPS = f"""{PTS},
  near AS (SELECT a.pid AS pid, b.pid AS other FROM pts a JOIN pts b ON list_distance(a.vec, b.vec) <= 1.0),
  counts AS (SELECT pid, count(*) AS neighbours, count(*) >= 16 AS is_core FROM near GROUP BY pid)"""


def class_points(t: Tables):
    table = cut_lineage(features.document_features(
        t.labelled().where("label = 1"), features=CLUSTER_FEATURES
    ).select("doc_id", "label", *CLUSTER_FEATURES))
    return cluster.class_points(table, id_col="doc_id")


def _code(column="lang"):
    return f"CASE {column} WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END"


def language_points(t: Tables):
    """All documents, standardised, with their language as cluster."""
    points = cluster.class_points(document_table(t), id_col="doc_id", label=None)
    codes = t.documents.select(F.col("doc_id").alias("pid"), F.expr(_code()).alias("cluster"))
    return points.join(codes, "pid")


@query("class_features", f"""SELECT doc_id, {', '.join('round(char_entropy, 6) AS char_entropy' if c == 'char_entropy' else c
    for c in CLUSTER_FEATURES)} FROM {q.features(_CLASS_DOCS, 'doc_id', CLUSTER_FEATURES)}""")
def class_features(t: Tables):
    table = features.document_features(t.labelled(), features=CLUSTER_FEATURES).where("label = 1")
    return table.select("doc_id", *CLUSTER_FEATURES).withColumn("char_entropy", F.round("char_entropy", 6))


_CENTROIDS = """cells AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
  centroids AS (SELECT label AS cluster, i, avg(x) AS m FROM cells GROUP BY label, i),
  d AS (SELECT vec_id, cluster, sum((x - m) * (x - m)) AS d2 FROM cells JOIN centroids USING (i) GROUP BY vec_id, cluster),
  best AS (SELECT vec_id AS pid, cluster, d2 FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) = 1)"""


def _embedding_points(t: Tables):
    return t.embeddings.select(
        F.col("vec_id").alias("pid"), F.col("embedding").cast("array<double>").alias("vec"), "label")


def _centroids(points):
    """Mean vector per label; partial sums are combined before the shuffle."""
    means = points.select("label", F.posexplode("vec").alias("i", "x")).groupBy("label", "i").agg(
        F.avg("x").alias("m"))
    return means.groupBy(F.col("label").alias("cluster")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("vec"))


def _assigned(t: Tables):
    points = _embedding_points(t)
    return cluster.nearest_centroid(points, _centroids(points))


@query("kmeans_assign", f"WITH {_CENTROIDS} SELECT pid, cluster, round(d2, 6) AS d2 FROM best")
def kmeans_assign(t: Tables):
    return _assigned(t).select("pid", "cluster", F.round("d2", 6).alias("d2"))


@query("cluster_sizes", f"WITH {_CENTROIDS} SELECT cluster, count(*) AS rows FROM best GROUP BY cluster")
def cluster_sizes(t: Tables):
    return cluster.cluster_sizes(_assigned(t))


_CLEAN_DOCS = f"(SELECT * FROM (SELECT doc_id, lang, {q.collapse('text')} AS text FROM documents) WHERE regexp_matches(text, '{q.W}'))"


def _z_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT {_code()} AS cluster, count(*) AS rows, '{c}' AS feature, "
        f"(avg({c}) - (SELECT avg({c}) FROM f)) / (SELECT stddev_samp({c}) FROM f) AS z FROM f GROUP BY ALL"
        for c in CLUSTER_FEATURES)


@query("cluster_profile", f"""WITH f AS {q.features(_CLEAN_DOCS, 'doc_id, lang', CLUSTER_FEATURES)},
  z AS ({_z_rows()}),
  r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY z DESC, feature) AS more_rank,
    row_number() OVER (PARTITION BY cluster ORDER BY z, feature) AS less_rank FROM z)
  SELECT cluster, rows, feature, round(z, 6) AS z, more_rank, less_rank FROM r WHERE more_rank <= 2 OR less_rank <= 2""")
def cluster_profile(t: Tables):
    table = document_table(t)
    codes = t.documents.select("doc_id", F.expr(_code()).alias("cluster"))
    profile = cluster.cluster_profile(table.join(codes, "doc_id"), table)
    return profile.withColumn("z", F.round("z", 6))


@query("eps_neighbours", f"WITH {EPS} SELECT pid, neighbours FROM counts")
def eps_neighbours(t: Tables):
    return cluster.neighbour_counts(class_points(t), eps=1.0)


@query("core_flags", f"WITH {EPS} SELECT pid, neighbours, is_core FROM counts")
def core_flags(t: Tables):
    return cluster.core_flags(class_points(t), eps=1.0, min_samples=16)


DBSCAN = f"""WITH RECURSIVE {EPS},
  links AS (SELECT n.pid, n.other FROM near n JOIN counts a ON n.pid = a.pid AND a.is_core JOIN counts b ON n.other = b.pid AND b.is_core),
  reach(root, pid) AS (SELECT pid, pid FROM counts WHERE is_core UNION SELECT r.root, l.other FROM reach r JOIN links l ON r.pid = l.pid),
  comp AS (SELECT pid, min(root) AS component FROM reach GROUP BY pid),
  border AS (SELECT n.pid, min(c.component) AS component FROM near n JOIN counts a ON n.pid = a.pid AND NOT a.is_core
    JOIN comp c ON n.other = c.pid GROUP BY n.pid),
  named AS (SELECT * FROM comp UNION ALL SELECT * FROM border),
  numbers AS (SELECT component, row_number() OVER (ORDER BY component) - 1 AS cluster FROM (SELECT DISTINCT component FROM comp)),
  result AS (SELECT counts.pid, coalesce(cluster, -1)::INT AS cluster, is_core FROM counts LEFT JOIN named ON counts.pid = named.pid
    LEFT JOIN numbers ON named.component = numbers.component)"""


@query("dbscan", f"{DBSCAN} SELECT pid, cluster, is_core FROM result")
def dbscan(t: Tables):
    return cluster.dbscan(class_points(t), eps=1.0, min_samples=16)


@query("noise_summary", f"""{DBSCAN} SELECT count(DISTINCT cluster) FILTER (cluster <> -1) AS clusters,
    count(*) FILTER (cluster = -1) AS noise, count(*) AS points, count(*) FILTER (cluster = -1) / count(*) AS noise_share FROM result""")
def noise_summary(t: Tables):
    return cluster.noise_summary(cluster.dbscan(class_points(t), eps=1.0, min_samples=16))


@query("k_distance", f"""WITH {PTS} SELECT pid, round(dist, 6) AS k_distance FROM (
    SELECT a.pid, list_distance(a.vec, b.vec) AS dist, row_number() OVER (PARTITION BY a.pid ORDER BY list_distance(a.vec, b.vec)) AS rn
    FROM pts a CROSS JOIN pts b) WHERE rn = 16""")
def k_distance(t: Tables):
    return cluster.k_distance(class_points(t), k=16).withColumn("k_distance", F.round("k_distance", 6))


@query("silhouette", f"""WITH f AS {q.features(_CLEAN_DOCS, 'doc_id, lang', CLUSTER_FEATURES)}, pts AS {_scaled_vector('f')},
  c AS (SELECT pid, vec, {_code()} AS cluster FROM pts JOIN documents ON pid = doc_id),
  sizes AS (SELECT cluster, count(*) AS n FROM c GROUP BY cluster),
  m AS (SELECT a.pid, a.cluster AS own, b.cluster AS other, sum(list_distance(a.vec, b.vec)) AS s
    FROM c a CROSS JOIN c b GROUP BY a.pid, a.cluster, b.cluster),
  ab AS (SELECT pid, own AS cluster, max(CASE WHEN own = other THEN s / greatest(n - 1, 1) END) AS a,
    max(CASE WHEN own = other THEN n END) AS n, min(CASE WHEN own <> other THEN s / n END) AS b
    FROM m JOIN sizes ON m.other = sizes.cluster GROUP BY pid, own)
  SELECT pid, cluster, round(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM ab""")
def silhouette(t: Tables):
    return cluster.silhouette(language_points(t)).withColumn("silhouette", F.round("silhouette", 6))


@query("kmeans_fit")
def kmeans_fit(t: Tables):
    points = class_points(t)
    return cluster.cluster_sizes(cluster.kmeans_assign(points, cluster.kmeans_fit(points)))


@query("kmeans_sweep")
def kmeans_sweep(t: Tables):
    return cluster.kmeans_sweep(class_points(t))


# What must hold of any fit, whatever its seeds; SQL knows what the fit must come to.
_FIT_FACTS = f"WITH {PTS}"


@query("kmeans_fit_facts", f"""{_FIT_FACTS} SELECT 5 AS clusters, (SELECT count(*) FROM pts) AS points, 0 AS empty, 0 AS not_nearest,
    0 AS off_their_mean, true AS cost_below_one_cluster""")
def kmeans_fit_facts(t: Tables):
    """Points that a nearer centroid would take, and centroids that are not the mean of their points: none."""
    points = cut_lineage(class_points(t))
    centroids = cut_lineage(cluster.kmeans_fit(points))
    assigned = cut_lineage(cluster.nearest_centroid(points, centroids))
    pairs = assigned.withColumn("_all", centroids.agg(F.collect_list("vec")).scalar())
    nearer = F.exists("_all", lambda c: cluster.squared_distance(F.col("vec"), c) < F.col("d2") - 1e-12)
    cells = assigned.select("cluster", F.posexplode("vec").alias("i", "x"))
    means = cells.groupBy("cluster", "i").agg(F.avg("x").alias("m"))
    own = centroids.select("cluster", F.posexplode("vec").alias("i", "c"))
    off = own.join(means, ["cluster", "i"]).where(F.abs(F.col("c") - F.col("m")) > 1e-5)
    one = points.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg((F.var_pop("x") * F.count("x")).alias("v"))
    return pairs.agg(
        F.count_distinct("cluster").cast("int").alias("clusters"), F.count(F.lit(1)).alias("points"),
        F.count_if(nearer).cast("int").alias("not_nearest"), F.sum("d2").alias("cost")).select(
        "clusters", "points", (5 - F.col("clusters")).alias("empty"), "not_nearest",
        off.agg(F.count(F.lit(1)).cast("int")).scalar().alias("off_their_mean"),
        (F.col("cost") < one.agg(F.sum("v")).scalar()).alias("cost_below_one_cluster"))


@query("kmeans_sweep_facts", f"""{_FIT_FACTS} SELECT unnest(range(2, 11))::INT AS k, true AS cost_falls,
    true AS cost_below_one_cluster, true AS score_in_range""")
def kmeans_sweep_facts(t: Tables):
    """More clusters cost less; silhouettes stay between -1 and 1."""
    points = cut_lineage(class_points(t))
    one = points.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg((F.var_pop("x") * F.count("x")).alias("v"))
    before = F.lag("inertia").over(Window.orderBy("k"))  # nine rows
    return cluster.kmeans_sweep(points).select(
        "k", F.coalesce(F.col("inertia") < before, F.lit(True)).alias("cost_falls"),
        (F.col("inertia") < one.agg(F.sum("v")).scalar()).alias("cost_below_one_cluster"),
        F.col("silhouette").between(-1, 1).alias("score_in_range"))


_NOISE = """count(DISTINCT cluster) FILTER (cluster <> -1) AS clusters, count(*) FILTER (cluster = -1) AS noise,
    count(*) AS points, count(*) FILTER (cluster = -1) / count(*) AS noise_share"""


def _noise_at(eps: float) -> str:
    return f"SELECT {eps}::DOUBLE AS eps, * FROM ({DBSCAN.replace('<= 1.0)', f'<= {eps})')} SELECT {_NOISE} FROM result)"


@query("eps_sweep", " UNION ALL ".join(_noise_at(eps) for eps in (0.5, 0.8, 1.0, 1.3)))
def eps_sweep(t: Tables):
    return cluster.eps_sweep(class_points(t))


# Power iteration; the second axis stays orthogonal to the first.
_UNIT = "list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))"
_SIGNED = "list_transform(v, lambda x: CASE WHEN list_max(v) >= -list_min(v) THEN x ELSE -x END)"


@query("pca2", f"""WITH RECURSIVE {PTS}, cells AS (SELECT pid, unnest(vec) AS x, unnest(range(len(vec))) AS i FROM pts),
  pairs AS (SELECT a.i AS i, b.i AS j, covar_pop(a.x, b.x) AS s FROM cells a JOIN cells b ON a.pid = b.pid GROUP BY a.i, b.i),
  m AS MATERIALIZED (SELECT list(r ORDER BY i) AS c FROM (SELECT i, list(s ORDER BY j) AS r FROM pairs GROUP BY i)),
  one(n, v) AS (SELECT 0, list_transform(c, lambda r, i: 1.0 / i) FROM m
    UNION ALL SELECT n + 1, {_UNIT} FROM (SELECT n, list_transform(c, lambda r: list_dot_product(r, v)) AS w FROM one, m WHERE n < 2000)),
  axis1 AS MATERIALIZED (SELECT v AS u FROM one WHERE n = 2000),
  two(n, v) AS (SELECT 0, list_transform(c, lambda r, i: 1.0 / i) FROM m
    UNION ALL SELECT n + 1, {_UNIT} FROM (SELECT n, list_transform(z, lambda x, i: x - list_dot_product(z, u) * u[i]) AS w
      FROM (SELECT n, u, list_transform(c, lambda r: list_dot_product(r, v)) AS z FROM two, m, axis1 WHERE n < 2000))),
  axes AS (SELECT (SELECT {_SIGNED.replace('list_transform(v', 'list_transform(u').replace('(v)', '(u)')} FROM axis1) AS first, (SELECT {_SIGNED} FROM two WHERE n = 2000) AS second)
  SELECT pid, round(list_dot_product(vec, first), 5) AS pc1, round(list_dot_product(vec, second), 5) AS pc2 FROM pts, axes""")
def pca2(t: Tables):
    return cluster.pca2(class_points(t)).select("pid", F.round("pc1", 5).alias("pc1"), F.round("pc2", 5).alias("pc2"))
