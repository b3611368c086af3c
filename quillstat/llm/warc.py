"""WARC archives of pages, and a normaliser of monolithic gzip.

Spark's text writer makes the archives: a record ends with the blank lines that it writes as line
separator, and its gzip codec compresses a file as one stream. The normaliser inflates such a stream
once, rewrites every record as a member of its own and writes an index line for each beside it.
A member of less than 16 MB ends with a zero byte, its size's highest; the writer's separator
supplies it. A larger one is followed by an empty member for that. Files can thus live in any store
that Spark writes to.
"""

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, query, table, written

RECORD_END = "\r\n\r\n"
#: Capture date written into records: the pages table has none.
DATE = "2024-01-01T00:00:00Z"
#: Most records of one archive file, and the number of bytes inflated at a time.
ARCHIVE_RECORDS, CHUNK = 20_000, 1 << 20
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("shard int, offset long, length long, archive string, record long, type string, page_id long, "
         "refers_to long, uri string, digest string, payload_bytes long")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_digests(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, payload_digest, payload_bytes``; null html is an empty payload."""
    out = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce("html", F.lit("")).alias("html"), F.lit("").alias("payload_digest"))

    def of(batches):
        for b in batches:
            digests = pa.array([digest_of(x.as_py().encode()) for x in b.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], digests], names=b.schema.names)

    return out.mapInArrow(of, out.schema).withColumn("payload_bytes", F.octet_length("html").cast("long"))


def records(pages: DataFrame) -> DataFrame:
    """One column ``record``: the WARC record of each page without its closing blank lines.

    Of pages with equal payloads (length and SHA-1) the one with the largest page_id is a response,
    the others are revisits of it; pages that share that id are all responses. A null id is never
    the largest; where all ids are null, all are responses. Null urls give no target.
    """
    full = with_digests(pages)
    key = ["payload_digest", "payload_bytes"]
    owners = full.groupBy(*key).agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    full = full.join(written(owners, "owners"), key, "left")
    revisit = F.col("owner").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("owner")))

    def urn(page):
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))

    def head(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    extra = F.when(revisit, F.concat(
        head("WARC-Refers-To", urn(F.col("owner"))), head("WARC-Profile", F.lit(_PROFILE)))).otherwise("")
    uri = F.when(F.col("url").isNotNull(), head("WARC-Target-URI", F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20"))).otherwise("")
    body = F.when(revisit, "").otherwise(F.col("html"))
    return full.select(F.concat(
        F.lit("WARC/1.1\r\n"), head("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        head("WARC-Record-ID", urn(F.col("page_id"))), head("WARC-Date", F.lit(DATE)), uri, extra,
        head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        head("X-Payload-Length", F.col("payload_bytes").cast("string")), head("Content-Type", F.lit("application/http; msgtype=response")),
        head("Content-Length", (F.octet_length(body) + len(_HTTP)).cast("string")), F.lit("\r\n" + _HTTP), body).alias("record"))


def write_archives(pages: DataFrame, folder: str) -> None:
    """Archives of one gzip stream each, at most ARCHIVE_RECORDS records long."""
    records(pages).write.options(lineSep=RECORD_END, compression="gzip", maxRecordsPerFile=ARCHIVE_RECORDS).text(folder)


def inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of all gzip members, a chunk at a time; a cut or broken stream raises zlib.error."""
    machine, at = zlib.decompressobj(31), 0
    view = memoryview(content)
    while at < len(view) or machine.unconsumed_tail:
        data = machine.unconsumed_tail or view[at:at + CHUNK]
        if not machine.unconsumed_tail:
            at += len(data)
        yield machine.decompress(data, CHUNK)
        while machine.eof and (machine.unused_data or at < len(view)):
            left, machine = machine.unused_data, zlib.decompressobj(31)
            if left:
                yield machine.decompress(left, CHUNK)
            else:
                break
    if not machine.eof and len(view):
        while tail := machine.decompress(machine.unconsumed_tail, CHUNK):
            yield tail
        if not machine.eof:
            raise zlib.error("the gzip stream ends early")


def parsed(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """``(header, block, whole record)`` of each record; memory holds one record and a chunk."""
    held = bytearray()

    def need(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        while need(1) and held[0] in b"\r\n":
            del held[:1]
        if not held:
            return
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not need(seen + 1):
                raise ValueError("a WARC header does not end")
        lines = held[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        header = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(header["content-length"])
        if not need(end + 4 + size):
            raise ValueError("a WARC record ends early")
        block = bytes(held[end + 4:end + 4 + size])
        record = bytes(held[:end + 4 + size])
        del held[:end + 4 + size]
        yield header, block, record


def facts(header: dict[str, str], block: bytes) -> dict:
    """What the index says of a record; a revisit's payload is described by its header."""
    def page(name: str):
        text = header.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text.lstrip("-").isdigit() else None

    kind = header.get("warc-type", "")
    payload = block.partition(b"\r\n\r\n")[2]
    whole = kind != "revisit"
    return {
        "type": kind, "page_id": page("warc-record-id"), "refers_to": page("warc-refers-to"),
        "uri": header.get("warc-target-uri"),
        "digest": digest_of(payload) if whole else header.get("warc-payload-digest", "").removeprefix("sha1:"),
        "payload_bytes": len(payload) if whole else int(header.get("x-payload-length", 0)),
    }


_EMPTY = zlib.compressobj(9, zlib.DEFLATED, 31).flush()


def member(record: bytes, level: int = 6) -> bytes:
    machine = zlib.compressobj(level, zlib.DEFLATED, 31)
    return machine.compress(record) + machine.flush()


def _in_batches(rows: Iterator[tuple[int, dict]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows given with their sizes, as batches of about CHUNK bytes."""
    held, size = [], 0
    for own, row in rows:
        held.append(row)
        size += own + 200
        if size >= CHUNK:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _members(batches):
    def lines():
        shard, offset, place = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                archive = path.as_py().rsplit("/", 1)[-1]
                for number, (header, block, record) in enumerate(parsed(inflated(content.as_py()))):
                    own = member(record + b"\r\n\r\n")
                    line = own if own.endswith(b"\0") else own + _EMPTY
                    note = json.dumps({"shard": shard, "offset": offset, "length": len(own), "archive": archive,
                                       "record": number} | facts(header, block))
                    yield len(line), {"kind": "warc", "place": place, "line": line[:-1]}
                    yield len(note), {"kind": "index", "place": place, "line": note.encode()}
                    offset, place = offset + len(line), place + 1

    return _in_batches(lines(), pa.schema([("kind", pa.string()), ("place", pa.int64()), ("line", pa.binary())]))


def normalise(spark, source: str, folder: str) -> None:
    """Rewrite the archives of ``source`` (a folder of .gz files, of one or more members each).

    ``folder/kind=warc`` gets files of one member a record, ``folder/kind=index`` a JSON line for
    each, ended by a zero byte: columns of INDEX. ``shard`` is the number in the file's name
    part-NNNNN, ``offset`` and ``length`` are the member's bytes in it. A broken archive fails the
    job with its reason; empty ones give no records.
    """
    lines = spark.read.format("binaryFile").load(source).select("path", "content").mapInArrow(
        _members, "kind string, place long, line binary")
    lines.sortWithinPartitions("kind", "place").select("kind", F.col("line").cast("string").alias("value")) \
        .write.options(lineSep="\0").partitionBy("kind").text(folder)


def read_index(spark, folder: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\0").text(f"{folder}/kind=index")
    return lines.select(F.from_json("value", INDEX).alias("x")).select("x.*")


_RECORD = [("shard", "int"), ("offset", "long"), ("type", "string"), ("page_id", "long"), ("refers_to", "long"),
           ("uri", "string"), ("digest", "string"), ("payload_bytes", "long"), ("payload", "binary")]
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def shard_of(path: str) -> int:
    """The number of a part file, which has five digits or more."""
    return int(path.rsplit("/part-", 1)[1].split("-", 1)[0])


def read_records(spark, folder: str, *, payloads: bool = True) -> DataFrame:
    """``shard, offset, type, page_id, refers_to, uri, digest, payload_bytes, payload`` read from the
    members themselves, each inflated alone; a member that is no record of its own fails the job.
    Without ``payloads`` they are only digested."""
    fields = [f for f in _RECORD if payloads or f[0] != "payload"]
    schema = pa.schema([(n, _ARROW[k]) for n, k in fields])

    def of(batches):
        def rows():
            for batch in batches:
                for path, content in zip(batch.column(0), batch.column(1)):
                    shard, content, at = shard_of(path.as_py()), memoryview(content.as_buffer()), 0
                    while at < len(content):
                        machine, parts, end, step = zlib.decompressobj(31), [], at, CHUNK // 32
                        while not machine.eof:
                            if end >= len(content):
                                raise zlib.error("a member ends early")
                            parts.append(machine.decompress(content[end:end + step]))
                            end, step = min(len(content), end + step), CHUNK
                        end -= len(machine.unused_data)
                        for header, block, _ in parsed(iter(parts)):
                            row = {"shard": shard, "offset": at} | facts(header, block)
                            if payloads:
                                row["payload"] = None if row["type"] == "revisit" else block.partition(b"\r\n\r\n")[2]
                            yield len(block) if payloads else 0, row
                        at = end

        return _in_batches(rows(), schema)

    files = spark.read.format("binaryFile").load(f"{folder}/kind=warc").select("path", "content")
    return files.mapInArrow(of, ", ".join(" ".join(f) for f in fields))


@query("op1_warc", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, unhex(sha1(h)) AS s, max(page_id) OVER (PARTITION BY h) AS o FROM p),
b AS (SELECT *, unnest(range(32)) AS k FROM d),
c AS (
  SELECT page_id, n, o, k, (ord_lo * 256 + ord_hi) >> (11 - (k * 5) % 8) & 31 AS v FROM (
    SELECT *, ('0x' || substr(hex(s), 2 * (k * 5 // 8) + 1, 2))::INT AS ord_lo,
      coalesce(('0x' || nullif(substr(hex(s), 2 * (k * 5 // 8) + 3, 2), ''))::INT, 0) AS ord_hi FROM b)
)
SELECT page_id, any_value(n)::BIGINT AS payload_bytes,
  string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v::INT + 1, 1), '' ORDER BY k) AS payload_digest,
  CASE WHEN any_value(o) = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN any_value(o) = page_id THEN NULL ELSE any_value(o) END AS refers_to
FROM c GROUP BY page_id
""")
def op1(spark, folder):
    """Pages to archives, archives to members, and what the members hold, found by their index."""
    first, second = new_folder(spark, "warc"), new_folder(spark, "warc-members")
    write_archives(table(spark, folder, "pages"), first)
    normalise(spark, first, second)
    index = read_index(spark, second).select("shard", "offset")
    return read_records(spark, second, payloads=False).join(index, ["shard", "offset"]).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
