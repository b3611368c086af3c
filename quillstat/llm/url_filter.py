"""URL filters by a cascade of Bloom filters: exact verdicts without joining pages and lists.

Every page has a few keys: each suffix of its host with each beginning of its path that a rule could
have. The distinct keys of the corpus are the complete universe. Level 0 of a cascade encodes the
listed keys; level 1 the other keys that level 0 passes; level 2 the listed ones that level 1 passes;
and so on until a level passes no wrong key. A key's first miss then tells for certain on which side
it stands. Levels are built by Spark aggregates, shrink geometrically, and follow the length of the
list, not of the corpus, but for the logarithm of their ratio.
"""

from dataclasses import dataclass
from math import ceil, log, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, query, table, written

ALLOW, BLOCK = "allow", "block"
#: Most bytes of the filters that are broadcast at once. Longer lists are cut into shards by hash,
#: each with a cascade and a pass over the hashed keys of its own.
FILTER_BYTES = 32 << 20
#: A later level passes half of the other side; many more levels than any list needs.
HALF, LEVELS = 0.5, 200
RULES = [
    ("com/", ALLOW), ("example.com/en/", BLOCK), ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK), ("net/fr/", BLOCK),
]
#: A host with one of these words between its dots and hyphens is listed by the query.
BAD_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")


@dataclass
class Level:
    """A Bloom filter of ``size`` bits, ``hashes`` of them a key, drawn anew on every level."""

    number: int
    size: int
    hashes: int
    words: np.ndarray

    def places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        first = _mixed(h1 + np.uint64(self.number * 2 + 1))
        step = _mixed(h2 ^ np.uint64(self.number * 2 + 2)) | np.uint64(1)
        turns = np.arange(self.hashes, dtype=np.uint64)[:, None]
        return (first + turns * step) % np.uint64(self.size)

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.places(h1, h2)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).all(axis=0)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves about half of the bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Cascade:
    """Exact for the keys it was built over; without levels nothing is listed."""

    levels: list[Level]

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        listed, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
        for level in self.levels:
            passed = level.passes(h1[open_], h2[open_])
            listed[open_[~passed]] = level.number % 2 == 1
            open_ = open_[passed]
        listed[open_] = len(self.levels) % 2 == 1
        return listed

    @property
    def size(self) -> int:
        return sum(level.words.nbytes for level in self.levels)


def _hashes(batch, *names) -> list[np.ndarray]:
    return [np.asarray(batch.column(n)).astype(np.int64).view(np.uint64) for n in names]


def _filter(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """The filter of all ``h1, h2`` rows; tasks set bits of their own before the shuffle."""
    size = max(64, ceil(count * -log(rate) / log(2) ** 2 / 64) * 64)
    level = Level(number, size, max(1, round(-log2(rate))), np.zeros(0, np.uint64))

    def bits(batches):
        for batch in batches:
            at = level.places(*_hashes(batch, "h1", "h2")).ravel()
            word, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            own, place = np.unique(word, return_inverse=True)
            mask = np.zeros(len(own), np.uint64)
            np.bitwise_or.at(mask, place.ravel(), bit)
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64)), pa.array(mask.view(np.int64))], names=["word", "bits"])

    set_words = keys.select("h1", "h2").mapInArrow(bits, "word long, bits long").groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    level.words = np.zeros(size // 64, np.uint64)
    level.words[np.asarray(set_words["word"])] = np.asarray(set_words["bits"]).astype(np.int64).view(np.uint64)
    return level


def build_cascade(universe: DataFrame) -> Cascade:
    """Of ``h1, h2, listed``, one row a key."""
    alive = universe.select("h1", "h2", "listed")
    levels: list[Level] = []
    while len(levels) < LEVELS:
        number, side = len(levels), len(levels) % 2 == 0
        counts = {r.listed: r["count"] for r in alive.groupBy("listed").count().collect()}
        mine, theirs = counts.get(side, 0), counts.get(not side, 0)
        if not mine:
            break
        rate = min(HALF, mine * sqrt(HALF) / theirs) if number == 0 and theirs else HALF
        level = _filter(alive.filter(F.col("listed") == side), number, mine, rate)
        levels.append(level)
        if not theirs:
            break
        shared = alive.sparkSession.sparkContext.broadcast(level)

        def left(batches, shared=shared, side=side):
            for batch in batches:
                own = np.asarray(batch.column("listed")) == side
                yield batch.filter(pa.array(own | shared.value.passes(*_hashes(batch, "h1", "h2"))))

        alive = written(alive.mapInArrow(left, alive.schema), "cascade-level")
        shared.destroy()
    else:
        raise ValueError("two keys have the same 128-bit hash")
    return Cascade(levels)


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def cascades(keys: DataFrame, lists: dict[str, DataFrame]) -> dict[str, list[Cascade]]:
    """Cascades of each list, one a shard of keys, over the ``key`` rows of the corpus and of the lists."""
    flags = list(lists)
    rows = keys.select(*_hashed(F.col("key")), *[F.lit(False).alias(f) for f in flags])
    for name, listed in lists.items():
        rows = rows.union(listed.select(*_hashed(F.col("key")), *[F.lit(f == name).alias(f) for f in flags]))
    universe = written(rows.groupBy("h1", "h2").agg(*[F.max(f).alias(f) for f in flags]), "keys")
    total, *listed = universe.agg(F.count(F.lit(1)), *[F.count_if(F.col(f)) for f in flags]).first()
    # Level 0 has log2(1 / rate) / ln 2 bits a listed key, all later ones about six.
    size = sum(n * (max(1, log2(max(2, total / max(1, n)))) / log(2) + 6) / 8 for n in listed)
    shards = max(1, ceil(size / FILTER_BYTES))
    return {f: [build_cascade(universe.filter(F.pmod("h2", F.lit(shards)) == s).withColumn("listed", F.col(f)))
                for s in range(shards)] for f in flags}


def mark(df: DataFrame, keys: str, built: dict[str, list[Cascade]]) -> DataFrame:
    """``df`` with an array of booleans for each list: which of the row's ``keys`` are listed."""
    out = df.withColumns({
        "h1": F.transform(keys, lambda k: _hashed(k)[0]), "h2": F.transform(keys, lambda k: _hashed(k)[1]),
        **{f: F.transform(keys, lambda k: F.lit(False)) for f in built}})
    shards = len(next(iter(built.values())))
    for shard in range(shards):
        own = df.sparkSession.sparkContext.broadcast({f: c[shard] for f, c in built.items()})

        def of(batches, own=own, shard=shard):
            for batch in batches:
                lists = batch.column("h1").combine_chunks() if isinstance(batch.column("h1"), pa.ChunkedArray) else batch.column("h1")
                ends = pa.array(np.cumsum([0, *lists.value_lengths().to_pylist()]).astype(np.int32))
                h1, h2 = (np.asarray(batch.column(n).flatten()).astype(np.int64).view(np.uint64) for n in ("h1", "h2"))
                mine = h2.view(np.int64) % shards == shard
                columns = {n: batch.column(n) for n in batch.schema.names}
                for name, cascade in own.value.items():
                    found = np.array(batch.column(name).flatten().to_numpy(zero_copy_only=False), bool)
                    found[mine] = cascade.contains(h1[mine], h2[mine])
                    columns[name] = pa.ListArray.from_arrays(ends, pa.array(found, pa.bool_()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        out = out.mapInArrow(of, out.schema)
        if shards > 1:
            out = written(out, "marked")
    return out.drop("h1", "h2")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    """The host and what follows each of its dots, longest first."""
    labels = F.split(host, "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(
        F.slice(labels, k, F.size(labels) - k + 1), "."))


def page_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Keys a rule could have for the page, the longest first; of equally long ones that of the longest host."""
    sizes = F.array([F.lit(n) for n in lengths])
    fits = F.filter(sizes, lambda n: n <= F.length(path))
    pairs = F.flatten(F.transform(_suffixes(host), lambda h: F.transform(fits, lambda n: F.struct(
        (-F.length(h) - n).alias("order"), n.alias("path"), F.concat(h, F.substr(path, F.lit(1), n)).alias("key")))))
    return F.transform(F.array_distinct(F.array_sort(pairs)), lambda p: p["key"])


def judge_urls(pages: DataFrame, rules: DataFrame, hosts: DataFrame, *, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    ``rules`` are (rule, action): a rule is a host and a beginning of paths (``example.com/en/``); it
    fits the host and its subdomains. The longest fitting rule's action is the verdict; of a rule
    given twice ``allow`` holds. Pages that no rule fits are blocked where their host or one it
    belongs to is in ``hosts`` (host), else allowed. Null or odd urls have an empty host and path.
    An empty table of pages, rules or hosts is fine; null rules and hosts are left out. Pages must
    not have the new columns, nor ``_keys, h1, h2`` or those of the lists.
    """
    clash = {"host", "path", "rule", "verdict", "_keys", "h1", "h2", ALLOW, BLOCK, "listed"} & set(pages.columns)
    if clash:
        raise ValueError(f"pages already has columns {sorted(clash)}")
    split = rules.filter("rule is not null").select(
        ascii_lower(F.regexp_extract("rule", "^[^/]*", 0)).alias("h"), F.regexp_extract("rule", "^[^/]*(.*)$", 1).alias("p"), "action")
    lengths = sorted({0, *(r.n for r in split.select(F.length("p").alias("n")).distinct().collect())})
    given = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    keyed = given.withColumn("_keys", page_keys(F.col("host"), F.col("path"), lengths))
    # A key is taken from distinct hosts and beginnings of paths, not from every page.
    kinds = given.select("host", F.substr("path", F.lit(1), F.lit(max(lengths))).alias("path")).distinct()
    universe = kinds.select(F.explode(page_keys(F.col("host"), F.col("path"), lengths)).alias("key"))
    key = F.concat("h", "p").alias("key")
    built = cascades(universe, {
        ALLOW: split.filter(F.col("action") == ALLOW).select(key), BLOCK: split.filter(F.col("action") == BLOCK).select(key),
        "listed": hosts.filter("host is not null and host <> ''").select(ascii_lower(F.col("host")).alias("key"))})
    marked = mark(keyed, "_keys", built)
    at = F.array_position(F.zip_with(ALLOW, BLOCK, lambda a, b: a | b), True)
    action = F.when(F.element_at(ALLOW, at.cast("int")), ALLOW).otherwise(BLOCK)
    by_host = F.when(F.exists("listed", lambda x: x), BLOCK).otherwise(ALLOW)
    return marked.select(
        *[F.col(f"`{c}`") for c in pages.columns], "host", "path",
        F.when(at > 0, F.element_at("_keys", at.cast("int"))).alias("rule"),
        F.when(at > 0, action).otherwise(by_host).alias("verdict"))


def bad_hosts(pages: DataFrame, *, url: str = "url", words=BAD_WORDS) -> DataFrame:
    """Distinct hosts of the pages with one of ``words`` between dots and hyphens."""
    hosts = pages.select(host_of(F.col(url)).alias("host")).distinct()
    return hosts.filter(F.arrays_overlap(F.split("host", "[.-]"), F.array([F.lit(w) for w in words])))


def rule_table(spark: SparkSession, rules=tuple(RULES)) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule string, action string")


_VALUES = ", ".join(f"('{r}', '{a}')" for r, a in RULES)
_SQL = f"""
WITH p AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT rule, action, split_part(rule, '/', 1) AS h, substr(rule, length(split_part(rule, '/', 1)) + 1) AS b FROM (VALUES {_VALUES}) v(rule, action)),
kinds AS (SELECT DISTINCT host, path FROM p),
fit AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM kinds JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, b) GROUP BY host, path),
bad AS (SELECT DISTINCT host AS b FROM p WHERE list_has_any(string_split_regex(host, '[.-]'), [{", ".join(f"'{w}'" for w in BAD_WORDS)}])),
listed AS (SELECT DISTINCT host FROM (SELECT DISTINCT host FROM p) JOIN bad ON host = b OR ends_with(host, '.' || b))
SELECT page_id, p.host, p.path, rule, coalesce(action, CASE WHEN listed.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path LEFT JOIN listed ON p.host = listed.host
"""


@query("op12_url_filter", _SQL)
def op12(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, rule_table(spark), bad_hosts(pages)).select("page_id", "host", "path", "rule", "verdict")
