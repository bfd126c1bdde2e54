"""WARC archives written by Spark, and captures assembled from their records.

Writing is all expressions: each page becomes a request, a response or revisit, and a metadata
record, the outer two concurrent to the middle one. Spark's text writer puts the bytes down as they
are (its line feed is the last byte of a record's end), so files appear by its commit only and on any
file system. Of equal payloads of at least LEAST_PAYLOAD bytes, the greatest page id holds the
response, the others revisit it.

Reading parses whole files (of about FILE_BYTES each) and joins records to captures by
WARC-Concurrent-To: one nested row a capture, whatever order or file its records are in.

Cases: a null html counts as empty; a null url has no target; a null page id stays null (and comes
last when the greatest is chosen); of repeated rows one holds the response, as of any equal payloads
of that size; smaller ones are all responses; line breaks in urls are dropped; an empty table writes
no record and reads as no row; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_dir

LEAST_PAYLOAD = 1000
FILE_BYTES = 16 << 20
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
RECORD = "record_id string, concurrent_to string, type string, target string, refers_to string, http string, payload_bytes long, payload_digest string, payload binary, fields map<string,string>"


def decide(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """pages (page_id, url, html) with digest (hex SHA-1), bytes, copy (of an equal row) and keeper:
    the page id that equal payloads refer to, null where the row is itself a response.

    Payloads move once, spread by (page_id, digest); groups of equal payloads only by their digests.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.col("url").cast("string"), r"[\r\n]", "").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8"))).withColumn("bytes", F.octet_length("html").cast("long"))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    # At least as many as joins make by themselves: fewer, and they would deal the payloads anew.
    files = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE_BYTES))
    large = rows.where(F.col("bytes") >= least).select("page_id", "digest")
    keepers = large.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # A page id as text, null among them, joins plainly: one deal serves the join and the window.
    named = F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("name")
    asked = large.select(named, "digest").distinct().join(keepers, "digest")
    spread = rows.select("*", named).repartition(files, "name", "digest")
    joined = spread.join(asked, ["name", "digest"], "left")
    copy = F.row_number().over(Window.partitionBy("name", "digest").orderBy("url")) - 1
    out = joined.withColumn("copy", copy.cast("long")).drop("name")
    itself = F.col("keeper").isNull() | (F.col("keeper").eqNullSafe(F.col("page_id")) & (F.col("copy") == 0))
    return out.withColumn("keeper", F.when(~itself, F.col("keeper")))


def _id(kind: str, page: Column, digest: Column, copy: Column) -> Column:
    name = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("null")), digest, copy.cast("string"), F.lit(kind)).cast("binary"))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str | Column, headers: list[tuple[str, Column | str]], body: Column, date: str) -> Column:
    """A record's text but for its last line feed; null headers are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.concat(F.lit(f"{k}: "), v if isinstance(v, Column) else F.lit(v), F.lit(END)) for k, v in headers]
    head = F.concat(F.lit(f"{VERSION}{END}WARC-Type: "), kind, F.lit(f"{END}WARC-Date: {date}{END}"), *(F.coalesce(x, F.lit("")) for x in lines), F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(END * 2))
    return F.concat(head, body, F.lit(END + "\r"))


def write(pages: DataFrame, path: str, least: int = LEAST_PAYLOAD, date: str | None = None, compression: str = "gzip") -> None:
    """Archives of pages (page_id, url, html) below path; date: of the captures, in UTC, now by default."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = decide(pages, least)
    page, digest, copy, keeper = (F.col(c) for c in ("page_id", "digest", "copy", "keeper"))
    revisit = keeper.isNotNull()
    me, no_copy = _id("response", page, digest, copy), F.lit(0)
    labelled = F.concat(F.lit("sha1:"), digest)
    target = F.col("url")
    host = F.regexp_extract(F.coalesce(target, F.lit("")), r"^[a-zA-Z]+://([^/?#]*)", 1)
    local = F.regexp_replace(F.coalesce(target, F.lit("/")), r"^[a-zA-Z]+://[^/?#]*", "")
    asked = F.concat(F.lit("GET "), F.when(local == "", F.lit("/")).otherwise(local), F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END * 2))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END * 2))
    uri = ("WARC-Target-URI", target)
    request = _record("request", [("WARC-Record-ID", _id("request", page, digest, copy)), ("WARC-Concurrent-To", me), uri, ("Content-Type", "application/http; msgtype=request")], asked, date)
    middle = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        [
            ("WARC-Record-ID", me), uri, ("WARC-Payload-Digest", labelled), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Profile", F.when(revisit, F.lit(IDENTICAL))), ("WARC-Refers-To", F.when(revisit, _id("response", keeper, digest, no_copy))),
        ],
        F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html"))),
        date,
    )
    facts = F.concat_ws(END, F.concat(F.lit("page-id: "), page.cast("string")), F.concat(F.lit("refers-to-page-id: "), keeper.cast("string")), F.lit(""))
    notes = _record("metadata", [("WARC-Record-ID", _id("metadata", page, digest, copy)), ("WARC-Concurrent-To", me), uri, ("Content-Type", "application/warc-fields")], facts, date)
    joined = F.concat(request, F.lit("\n"), middle, F.lit("\n"), notes)
    rows.select(joined.alias("value")).write.option("lineSep", "\n").option("compression", compression).text(path)


def parse(data: bytes):
    """(headers with lower-case names, block) of each record in a file's bytes."""
    at, stop = 0, len(data)
    while at < stop:
        head = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:head].decode("utf-8").split(END)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        at = head + 4 + int(headers["content-length"])
        yield headers, data[head + 4 : at]
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record not ended at byte {at}")
        at += 4


def _digest(value: str | None) -> str | None:
    """Lower-case hex of a SHA-1 written as hex or base 32."""
    own = value and value.rpartition(":")[2]
    return base64.b32decode(own).hex() if own and len(own) == 32 else own and own.lower()


def records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record below path. payload_bytes and payload_digest are of the full payload: from the
    block of a response, from the stored headers of a revisit. payloads False leaves payload null."""

    def read(batches):
        for b in batches:
            for data in b.column("content").to_pylist():
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                rows = []
                for h, block in parse(data):
                    kind = h.get("warc-type")
                    row = {"record_id": h.get("warc-record-id"), "concurrent_to": h.get("warc-concurrent-to"), "type": kind, "target": h.get("warc-target-uri"), "refers_to": h.get("warc-refers-to")}
                    if kind == "metadata":
                        row["fields"] = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8").split(END) if x)]
                    elif kind in ("request", "response", "revisit"):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        row["http"] = http.decode("utf-8", "replace")
                        if kind == "response":
                            row |= {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest(), "payload": payload if payloads else None}
                        elif kind == "revisit":
                            sizes = [int(x.partition(":")[2]) for x in row["http"].split(END) if x.lower().startswith("content-length:")]
                            row |= {"payload_bytes": sizes[0] if sizes else None, "payload_digest": _digest(h.get("warc-payload-digest"))}
                    rows.append(row)
                for k in range(0, len(rows), 512):
                    yield pa.RecordBatch.from_pylist(rows[k : k + 512], schema=SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(read, RECORD)


SCHEMA = pa.schema([(n, t) for n, t in (("record_id", pa.string()), ("concurrent_to", pa.string()), ("type", pa.string()), ("target", pa.string()), ("refers_to", pa.string()), ("http", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("fields", pa.map_(pa.string(), pa.string())))])


def captures(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row a capture: (capture_id, page_id, target, request, response, metadata), nested.

    A record belongs to the one it is concurrent to, or to itself. A capture without one of its
    records has null there.
    """
    found = records(spark, path, payloads)
    middle = F.col("type").isin("response", "revisit")
    parts = {"request": F.col("type") == "request", "response": middle, "metadata": F.col("type") == "metadata"}
    whole = {
        "request": F.struct("record_id", "http"),
        "response": F.struct("record_id", "type", "refers_to", "http", "payload_bytes", "payload_digest", "payload"),
        "metadata": F.struct("record_id", "fields"),
    }
    keyed = found.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
    own = lambda on, value: F.first(F.when(on, value), ignorenulls=True)
    out = keyed.agg(own(middle, F.col("target")).alias("target"), *(own(on, whole[k]).alias(k) for k, on in parts.items()))
    return out.withColumn("page_id", F.expr("try_cast(try_element_at(metadata.fields, 'page-id') AS bigint)")).withColumn("refers_to_page", F.expr("try_cast(try_element_at(metadata.fields, 'refers-to-page-id') AS bigint)"))


def archive(pages: DataFrame, least: int = LEAST_PAYLOAD, payloads: bool = True) -> DataFrame:
    """Writes pages as archives in the shared folder and reads their captures back."""
    spark = pages.sparkSession
    path = shared_dir(spark)
    write(pages, path, least)
    return captures(spark, path, payloads)
