"""WARC archives with repeated payloads stored once.

Headers (digest, length, id: no payloads) are shuffled by payload digest; of equal payloads the record with
the smallest id stays a response and the others become revisits that refer to it. Archives are written with
fresh headers by Spark's text writer, whose rows and line ends are exactly a WARC stream, so they land in
whatever store the session writes to. Reading back parses each archive by Content-Length, checks every
response against its digest, and joins the revisits to their originals.

Nulls and odd rows: a null or empty payload is a payload of 0 bytes; a null url becomes `urn:page:<id>`;
control characters and blanks in a url are percent-encoded. A null id sorts after all ids, and where a whole group has
null ids nothing can be referred to, so all stay responses. Of repeated rows (same id, same payload) one is
the response and the rest refer to it. An empty table gives no archives and no rows. Further columns are
ignored. A record never refers across payloads shorter than `min_bytes`; those are all responses.
"""

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path
from .common import stored

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_ARCHIVE = 1000
RECORD = ("record_id string, record_type string, page_id bigint, target_uri string, payload_digest string, "
          "refers_to_id string, payload_bytes bigint, payload string")


def sha1_base32(text: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in base 32: five hex digits are four letters."""
    digest = F.sha1(text)
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(ALPHABET), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1))
                    for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def record_id(page: Column, digest: Column, copy: Column) -> Column:
    """A name that follows from the record alone, so that repeated runs write the same archives."""
    h = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("")), digest, copy.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_digest, payload_bytes, copy, record_type, first_id for every row."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), sha1_base32(payload).alias("payload_digest"),
                        F.octet_length(payload).cast("bigint").alias("payload_bytes"))
    heads = rows.filter(F.col("payload_bytes") >= min_bytes).select("payload_digest", "page_id")
    per_id = heads.groupBy("payload_digest", "page_id").agg(F.count("*").alias("n"))
    groups = per_id.groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.sum("n").alias("n"), F.min_by("n", "page_id").alias("n_first"))
    # Groups of one need nothing; the table of the others is written, so Spark knows whether it is small.
    groups = stored(groups.filter((F.col("n") > 1) & F.col("first_id").isNotNull()), "warc-groups")
    joined = rows.join(groups.select("payload_digest", "first_id", "n_first"), "payload_digest", "left")
    is_first = F.col("page_id") == F.col("first_id")
    kinds = F.when(F.col("first_id").isNull() | ((F.col("page_id") == F.col("first_id")) & (F.col("copy") == 0)), "response") \
        .otherwise("revisit")
    tied = F.coalesce(is_first & (F.col("n_first") > 1), F.lit(False))
    plain = joined.filter(~tied).withColumn("copy", F.lit(0))
    if groups.filter(F.col("n_first") > 1).isEmpty():
        numbered = plain
    else:
        order = Window.partitionBy("payload_digest", "page_id").orderBy(F.col("url").asc_nulls_last())
        numbered = plain.unionByName(joined.filter(tied).withColumn("copy", F.row_number().over(order) - 1))
    return numbered.withColumn("record_type", kinds).drop("n_first")


def records(resolved: DataFrame, date: str) -> Column:
    """The text of a record up to the last line end, which the writer adds."""
    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))

    revisit = F.col("record_type") == "revisit"
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    # url_encode of the few offending characters only: everything printable stays as it is.
    uri = F.coalesce(F.col("url"), F.concat(F.lit("urn:page:"), page))
    for code in [*range(0x21), 0x7F]:
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    referred = F.concat(line("WARC-Profile", PROFILE),
                        line("WARC-Refers-To", record_id(F.col("first_id"), F.col("payload_digest"), F.lit(0))))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"), F.col("copy"))),
        line("WARC-Date", date), line("WARC-Target-URI", uri), line("WARC-Page-ID", page),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, referred).otherwise(""), line("Content-Type", "application/http;msgtype=response"),
        line("Content-Length", length.cast("string")), F.lit("\r\n"), http,
        F.when(revisit, "").otherwise(F.col("payload")), F.lit("\r\n"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write `pages` as gzip-compressed archives of RECORDS_PER_ARCHIVE records at most below `path`."""
    resolved = resolve(pages, min_bytes)
    (resolved.select(records(resolved, date).alias("value")).write.option("lineSep", "\r\n")
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path))


def _parse(stream: io.BufferedIOBase) -> Iterator[dict]:
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {first[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            head[name.strip().lower().decode()] = value.strip().decode()
        block = stream.read(int(head["content-length"]))
        if len(block) != int(head["content-length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {head.get('warc-record-id')} is cut short")
        yield head | {"payload": block.partition(b"\r\n\r\n")[2]}


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record (see RECORD); payload_bytes and payload are null for revisits."""
    fields = {f.name: None for f in _schema()}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as stream:
                    for record in _parse(stream):
                        own = record["warc-type"] != "revisit"
                        digest = record["warc-payload-digest"].removeprefix("sha1:")
                        if own and base64.b32encode(hashlib.sha1(record["payload"]).digest()).decode() != digest:
                            raise ValueError(f"record {record['warc-record-id']} does not match its digest")
                        rows.append(fields | {
                            "record_id": record["warc-record-id"], "record_type": record["warc-type"],
                            "page_id": int(record["warc-page-id"]) if record.get("warc-page-id") else None,
                            "target_uri": record.get("warc-target-uri"), "payload_digest": digest,
                            "refers_to_id": record.get("warc-refers-to"),
                            "payload_bytes": len(record["payload"]) if own else None,
                            "payload": record["payload"].decode() if own and with_payload else None})
                        held += len(record["payload"]) if with_payload else 0
                        if held > 1 << 23 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_schema())
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_schema())

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, RECORD)


def _schema() -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in RECORD.split(", "))])


def resolved_records(read: DataFrame) -> DataFrame:
    """Every record with the digest and length of its full payload; a revisit has its original's.

    A revisit whose original is missing keeps its own digest and has no length and no original.
    """
    heads = read.drop("payload")
    originals = heads.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("original_bytes"))
    revisits = heads.filter("record_type = 'revisit'").join(originals, "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return heads.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("bigint")).select(
        *columns).unionByName(revisits.withColumn("payload_bytes", F.col("original_bytes")).select(*columns))


def archive_and_read(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and return what reading them back gives."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    # Parsed once into a table of headers; both sides of the join read that.
    return resolved_records(stored(read_archives(spark, path, with_payload=False).drop("payload"), "warc-heads"))
