"""Web archives: writing WARC files, reading them back, joining segmented records.

A page becomes one record: a ``response`` with its payload in chunked transfer
framing, or a ``revisit`` that names the page with the same payload.  A
response longer than ``SEGMENT`` bytes is cut into segments: the first has the
record's own headers, the rest are ``continuation`` records that name it as
their origin and carry their number, the last also the total length.

Archives are ordinary Spark output (text with the four bytes that end a
WARC record as line separator, gzip): written by Spark's committer, so a lost
task leaves nothing behind, on any file system that Spark can write.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import pieces, saved
from corpusmill.session import prepare, scratch_path

SEGMENT = 32 << 10
CHUNK = 4 << 10
FILE_BYTES = 32 << 20
END = b"\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"

RECORD = "record_id string, type string, uri string, page_id {id}, row bigint, segment int, origin string, total bigint, " \
         "digest string, refers_to {id}, block binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes) -> bytes:
    """Chunked transfer framing: sizes in hexadecimal, a zero chunk at the end."""
    out = [b"%X\r\n%b\r\n" % (len(c), c) for c in (payload[i:i + CHUNK] for i in range(0, len(payload), CHUNK))]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped.  ValueError if it is damaged."""
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        size = int(body[at:eol].split(b";")[0], 16)
        at = eol + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        out.append(body[at:at + size])
        at += size + 2


def record_id(page_id, row: int) -> str:
    h = hashlib.md5(f"{page_id}/{row}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def header(fields: list) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def page_records(page_id, row: int, url: str | None, payload: bytes, refers_to, revisit: bool):
    """The record of one page, in as many pieces as it needs, without the separator that ends a record."""
    ident, uri, digest = record_id(page_id, row), quote(url or "", safe="%/:=&?~#+!$,;'@()*[]"), "sha1:" + payload_digest(payload)
    own = [("WARC-Record-ID", ident), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("X-Page-ID", page_id), ("X-Row", row), ("WARC-Payload-Digest", digest)]
    if revisit:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        yield header([("WARC-Type", "revisit"), *own, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                      ("X-Refers-To-Page-ID", refers_to), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]) + block
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    kind = ("Content-Type", "application/http;msgtype=response")
    if len(block) <= SEGMENT:
        yield header([("WARC-Type", "response"), *own, kind, ("Content-Length", len(block))]) + block
        return
    cuts = [block[i:i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    for n, cut in enumerate(cuts, 1):
        if n == 1:
            fields = [("WARC-Type", "response"), *own, ("WARC-Segment-Number", 1), kind]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(f"{page_id}+{n}", row)), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
                      ("X-Page-ID", page_id), ("X-Row", row), ("WARC-Segment-Origin-ID", ident), ("WARC-Segment-Number", n),
                      ("WARC-Segment-Total-Length", len(block) if n == len(cuts) else None)]
        yield header([*fields, ("Content-Length", len(cut))]) + cut


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record per row of ``pages`` under ``path``.

    Of rows with equal payloads the one with the largest page_id is the
    response and the others revisit it; rows that repeat that page_id are
    responses too.  A null html is an empty payload, a null url an empty
    target; a row without page_id revisits if a row with one has its payload, else it is a response.  Payloads are
    compared by SHA-1 and length; only those that occur twice or more are
    joined back, never the bytes themselves grouped.
    """
    prepare(pages.sparkSession)
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    keyed = src.withColumn("k", F.sha1(F.col("html").cast("binary"))).withColumn("n", F.octet_length("html"))
    sums = saved(keyed.groupBy("k", "n").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("rows")), "warc-payloads")
    twice = saved(sums.where("rows > 1").select("k", "n", "keeper"), "warc-twice")
    size = sums.agg(F.sum(F.col("n") * F.col("rows")).alias("b"), F.sum("rows").alias("r")).first()
    small = twice.limit(500_001).count() <= 500_000
    rows = keyed.join(F.broadcast(twice) if small else twice, ["k", "n"], "left").select(
        "page_id", "url", "html", "keeper", F.coalesce((F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))), F.lit(False)).alias("revisit"),
        F.monotonically_increasing_id().alias("row"))

    def run(batches):
        for b in pieces(batches, "html"):
            out = [r for p, u, h, k, again, row in zip(*[c.to_pylist() for c in b.columns])
                   for r in page_records(p, row, u, h.encode(), k, again)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
    per_file = max(16, int(FILE_BYTES / (1024 + (size["b"] or 0) / max(1, size["r"] or 0))))
    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
         .write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))


def parse(data: bytes):
    """(header fields, block) of every record of an archive; each gzip member is read in turn.

    Raises ValueError where a record is cut short or does not end as its Content-Length says.
    """
    plain = []
    while data:
        d = zlib.decompressobj(31)
        plain.append(d.decompress(data) + d.flush())
        if not d.eof:
            raise ValueError("archive is cut short")
        data = d.unused_data
    data, at = b"".join(plain), 0
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(fields["content-length"])
        block = data[end + 4:end + 4 + length]
        at = end + 4 + length
        if len(block) != length or data[at:at + 4] != END:
            raise ValueError("record does not end as its Content-Length says")
        at += 4
        yield fields, block


def read_records(spark: SparkSession, path: str, id_type: str = "bigint", segmented: bool | None = None) -> DataFrame:
    """The records of all archives under ``path``; ``segmented`` picks those that are, or are not, segments."""
    prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    whole = (lambda v: int(v) if v is not None else None) if id_type in ("bigint", "int", "smallint", "tinyint") else (lambda v: v)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                rows, held = [], 0
                for f, block in parse(b.column(0)[i].as_py()):
                    number = f.get("warc-segment-number")
                    if segmented is not None and (number is not None) != segmented:
                        continue
                    rows.append({"record_id": f.get("warc-record-id"), "type": f.get("warc-type"), "uri": f.get("warc-target-uri"), "page_id": whole(f.get("x-page-id")),
                                 "row": int(f["x-row"]), "segment": int(number) if number else None,
                                 "origin": f.get("warc-segment-origin-id") or f.get("warc-record-id"),
                                 "total": int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
                                 "digest": f.get("warc-payload-digest", "").removeprefix("sha1:") or None, "refers_to": whole(f.get("x-refers-to-page-id")), "block": block})
                    held += len(block)
                    if held > 4 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)
    schema = RECORD.format(id=id_type)
    fields = spark.createDataFrame([], schema).schema

    def batch(rows):
        from corpusmill.llm.common import arrow_type
        return pa.RecordBatch.from_pylist(rows, pa.schema([(f.name, arrow_type(f.dataType)) for f in fields]))
    return files.mapInArrow(run, fields)


def reassemble(segments: DataFrame) -> DataFrame:
    """One record per origin from its segments: ordered by number, none missing, total length verified.

    Segments of one record are its own bytes, so a group is no larger than
    the record.  A missing, surplus or contradicting segment is an error; equal copies of one are not.
    """
    s = F.struct("segment", "total", "block", "type", "uri", "page_id", "digest", "record_id")
    groups = segments.groupBy("origin", "row").agg(F.array_sort(F.array_distinct(F.collect_list(s))).alias("s"))
    first = F.col("s")[0]
    total = F.array_max(F.transform("s", lambda x: x["total"]))
    # The bytes of all segments, joined through hexadecimal text: array_join takes strings.
    block = F.unhex(F.array_join(F.transform("s", lambda x: F.hex(x["block"])), ""))
    complete = F.transform("s", lambda x: x["segment"]) == F.sequence(F.lit(1), F.size("s"))
    joined = groups.select(first["record_id"].alias("record_id"), first["type"].alias("type"), first["uri"].alias("uri"), first["page_id"].alias("page_id"),
                           "row", first["digest"].alias("digest"), complete.alias("complete"), total.alias("total"), block.alias("block"))
    wrong = ~F.coalesce(F.col("complete") & (F.octet_length("block") == F.col("total")), F.lit(False))
    return joined.withColumn("block", F.when(wrong, F.raise_error(F.concat(F.lit("segments do not make up record "), F.coalesce("record_id", F.lit("?")))).cast("binary"))
                             .otherwise(F.col("block")))


def payload_of(block: bytes) -> tuple[bytes | None, int]:
    """Payload and its length from an HTTP block; a block without a body (a revisit) only has the length."""
    head, _, body = block.partition(END)
    names = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if names.get(b"transfer-encoding", b"").lower() == b"chunked":
        payload = unchunked(body)
        return payload, len(payload)
    return (body if body else None), int(names.get(b"content-length", len(body)))


def decode(records: DataFrame, with_payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to[, uri, payload]) of whole records, digests verified."""
    id_type = records.schema["page_id"].dataType
    schema = f"page_id {id_type.simpleString()}, payload_bytes bigint, payload_digest string, record_type string, refers_to {id_type.simpleString()}" + \
        (", uri string, payload binary" if with_payload else "")

    def run(batches):
        from corpusmill.llm.common import arrow_type
        kind = arrow_type(id_type)
        for b in pieces(batches, "block"):
            out = []
            for digest, block in zip(b.column(3).to_pylist(), b.column(5).to_pylist()):
                payload, n = payload_of(block)
                if payload is not None and payload_digest(payload) != digest:
                    raise ValueError("payload does not match its digest")
                out.append((n, payload))
            cols = [b.column(0), pa.array([n for n, _ in out], pa.int64()), b.column(3), b.column(1), b.column(2).cast(kind)]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            if with_payload:
                cols, names = [*cols, b.column(4), pa.array([p for _, p in out], pa.binary())], [*names, "uri", "payload"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return records.select("page_id", "type", "refers_to", "digest", "uri", "block").mapInArrow(run, schema)


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """Every page of the archives under ``path``: whole records decoded where they are read, segmented ones joined first.

    Only segments are shuffled.  A revisit has no payload of its own: its
    length and digest are those of the page it refers to.
    """
    whole = decode(read_records(spark, path, id_type, segmented=False), with_payload)
    parts = reassemble(read_records(spark, path, id_type, segmented=True)).withColumn("refers_to", F.lit(None).cast(id_type))
    return whole.unionByName(decode(parts, with_payload))


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared scratch folder and read them back: one row per row of ``pages``.

    An empty table gives an empty result; columns other than the three named are not read.
    """
    spark = pages.sparkSession
    prepare(spark)
    path = scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col)
    return read_archives(spark, path, pages.schema[id_col].dataType.simpleString())
