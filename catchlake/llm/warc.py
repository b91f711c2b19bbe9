"""Web archives: writing captures as WARC records, and assembling them again when the archives are read.

Every row is a capture. A capture is three records: the request, the response (or a revisit of an earlier response with an equal payload) and a
metadata record. Request and metadata name the response in WARC-Concurrent-To. Archives are plain WARC files in the
shared folder, of a bounded number of bytes each, written by Spark's text writer with the records' closing line ends as its
separator: captures go to a folder for their size, and the files of a folder hold as many captures as fit. Reading parses each file by the records' lengths and then assembles the records of a capture into one
nested row; a revisit's payload is looked up in the response that it refers to.

Payloads are compared by their SHA-1, as the records carry it. Only digests and ids travel for that, not payloads: the
digests of payloads that occur more than once are joined back, by broadcast if they are measured small, else by shuffle,
where adaptive execution splits a digest that many rows have. Records of a capture lie side by side, so they meet in the
map-side part of the aggregation, before the shuffle.

Cases: a null payload is an empty one; a null URL has no target header; line ends in a URL are written as %0D and %0A.
Rows equal in id, URL and payload are captures of their own, told apart by a number in their records' names: one such row of
each travels to where it is written as often as there are rows, in blocks. Of payloads whose smallest id several rows have, all of these
are responses, and others refer to the first of them. A row without an id is always a response and nothing refers to it. An empty table gives no captures. A request or metadata record
without its response gives a capture whose response is null.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchlake.llm.common import ship_package
from catchlake.operators.sizing import measured
from catchlake.session import materialize, shared_path

CRLF, END = "\r\n", "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = T.StructType([
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("concurrent_to", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType()),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
])


def base32(hex40: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: 8 groups of 20 bits, 4 characters each."""
    groups = [F.conv(F.substring(hex40, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    digit = lambda v, shift: F.substring(F.lit(BASE32), F.shiftright(v, shift).bitwiseAND(F.lit(31)) + F.lit(1), F.lit(1))
    return F.concat(*[digit(v, shift) for v in groups for shift in (15, 10, 5, 0)])


def capture_name(*columns: str) -> Column:
    """What tells captures apart but for equal rows. A null is unlike an empty text."""
    return F.md5(F.concat_ws("\n", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]))


def record_id(kind: str, name: Column, copy: Column) -> Column:
    """A name that follows from the capture, so that a task run again writes the same record."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), name, copy.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record(kind: str, id_: Column, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """One record up to the line ends that close it. A header whose value is null is left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), id_),
             *[F.concat(F.lit(f"{name}: "), value) for name, value in headers], F.lit(f"Content-Type: {content_type}"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(END), block)


COPY_BLOCK = 1000


def numbered(plain: DataFrame, repeated: DataFrame) -> DataFrame:
    """Add _copy, which numbers equal rows from 0. repeated has _name and n of the captures that several rows have.

    Equal rows are the same whichever is which, so one of them goes on and is laid out n times, in blocks of rows that are dealt out.
    """
    marked = plain.join(measured(repeated=repeated.withColumnRenamed("_name", "_many"))["repeated"], F.col("_name") == F.col("_many"), "left").drop("_many")
    once = marked.filter(F.col("n").isNull()).drop("n").withColumn("_copy", F.lit(0).cast("long"))
    one = marked.filter(F.col("n").isNotNull()).dropDuplicates(["_name"])
    first = F.col("_block") * COPY_BLOCK
    blocks = one.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPY_BLOCK)))).repartition("_name", "_block")
    copies = blocks.withColumn("_copy", F.explode(F.sequence(first, F.least(first + COPY_BLOCK, F.col("n")) - 1))).drop("n", "_block")
    return once.unionByName(copies)


def with_first_capture(pages: DataFrame) -> DataFrame:
    """Columns page_id, url, body, _digest, _name, _copy and _first_id, _first_url, _first_name: the first capture of an equal payload, if that
    has a smaller id."""
    plain = pages.select(F.col("page_id"), F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
                         F.coalesce("html", F.lit("")).alias("body"))
    plain = plain.withColumn("_digest", base32(F.sha1(F.col("body").cast("binary")))).withColumn("_name", capture_name("page_id", "url", "_digest"))
    light = plain.groupBy("page_id", "url", "_digest").agg(F.count("*").alias("n"))
    light = materialize(light.withColumn("_name", capture_name("page_id", "url", "_digest")), "captures-by-name")  # no payloads
    groups = (light.filter(F.col("page_id").isNotNull()).groupBy("_digest")
              .agg(F.min(F.struct("page_id", "url", "_name")).alias("_first"), F.min("page_id").alias("_low"), F.max("page_id").alias("_high"))
              .filter(F.col("_low") < F.col("_high"))
              .select(F.col("_digest").alias("_shared"), *[F.col(f"_first.{c}").alias(f"_first_{name}") for c, name in (("page_id", "id"), ("url", "url"), ("_name", "name"))]))
    groups = measured(groups=materialize(groups, "shared-payloads"))["groups"]
    repeated = light.filter("n > 1").select("_name", "n")
    plain = plain.withColumn("_copy", F.lit(0).cast("long")) if repeated.isEmpty() else numbered(plain, repeated)
    later = F.col("page_id") > F.col("_first_id")
    return plain.join(groups, F.col("_digest") == F.col("_shared"), "left").drop("_shared").withColumns(
        {c: F.when(later, F.col(c)) for c in ("_first_id", "_first_url", "_first_name")})


#: Most bytes of a payload and captures in a file of that size: about 64 MB a file, or one capture.
FILE_SIZES = ((1 << 15, 2000), (1 << 19, 128), (1 << 23, 8), (None, 1))


def captures_as_text(pages: DataFrame, date: str) -> DataFrame:
    """One value for each page, the text of its three records, and the payload's bytes in _size."""
    rows = with_first_capture(pages).withColumns({
        "_id": record_id("response", F.col("_name"), F.col("_copy")),
        "_first_record": F.when(F.col("_first_id").isNotNull(), record_id("response", F.col("_first_name"), F.lit(0).cast("long")))})
    target, when_ = ("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date))
    beside = ("WARC-Concurrent-To", F.col("_id"))
    host = F.regexp_extract(F.coalesce("url", F.lit("")), "://([^/?#]*)", 1)
    ask = record("request", record_id("request", F.col("_name"), F.col("_copy")), [target, when_, beside], "application/http;msgtype=request",
                 F.concat(F.lit("GET / HTTP/1.1\r\nHost: "), host, F.lit(END)))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("body").cast("string"), F.lit(END))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest")))
    answer = record("response", F.col("_id"), [target, when_, digest], "application/http;msgtype=response", F.concat(head, F.col("body")))
    again = record("revisit", F.col("_id"), [
        target, when_, digest, ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.col("_first_record")), ("WARC-Refers-To-Target-URI", F.col("_first_url"))],
        "application/http;msgtype=response", head)
    note = record("metadata", record_id("metadata", F.col("_name"), F.col("_copy")), [target, when_, beside], "application/warc-fields",
                  F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")))
    middle = F.when(F.col("_first_id").isNull(), answer).otherwise(again)
    return rows.select(F.concat_ws(END, ask, middle, note).alias("value"), F.octet_length("body").alias("_size"))


def write_archives(pages: DataFrame, path: str, sizes: Sequence[tuple[int | None, int]] = FILE_SIZES, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write WARC files below a path. sizes lists, upwards, the most bytes of a payload (None for any) and how many captures a file of such
    payloads holds. A size that no payload has is not written."""
    rows, least = captures_as_text(pages, date), -1
    body = F.octet_length(F.coalesce("html", F.lit("")))
    bound = lambda most: F.lit(True) if most is None else F.col("_size") <= most
    largest = pages.agg(F.coalesce(F.max(body), F.lit(-1))).first()[0]
    for most, captures in sizes:
        if largest > least or least < 0:  # an empty table has an archive without captures
            (rows.filter((F.col("_size") > least) & bound(most)).select("value").write.option("lineSep", END).option("maxRecordsPerFile", captures)
             .option("compression", "none").text(f"{path}/upto-{most or 'any'}"))
        if most is None:
            break
        least = most


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of one archive, by their lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError("an archive ends inside a record's header")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        start, size = end + 4, int(headers["Content-Length"])
        block = memoryview(data)[start:start + size]
        if len(block) < size:
            raise ValueError("an archive ends inside a record's block")
        at = start + size + 4
        kind, payload, fields = headers["WARC-Type"], None, None
        if kind == "response":
            cut = data.find(b"\r\n\r\n", start, start + size)
            payload = block[cut + 4 - start:] if cut >= 0 else block[size:]
        elif kind == "metadata":
            fields = dict(x.split(": ", 1) for x in bytes(block).decode("utf-8", "replace").split("\r\n") if ": " in x)
        yield {"record_type": kind, "record_id": headers.get("WARC-Record-ID"), "concurrent_to": headers.get("WARC-Concurrent-To"),
               "refers_to": headers.get("WARC-Refers-To"), "target_uri": headers.get("WARC-Target-URI"),
               "payload_digest": headers.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
               "payload_bytes": None, "payload": payload, "fields": fields}


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row for each record of the archives below a path; digests and sizes of payloads are taken from the bytes read.

    A file is held by one task, so archives must stay small, as write_archives makes them.
    """
    ship_package(spark)
    arrow = [("record_type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
             ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
             ("fields", pa.map_(pa.string(), pa.string()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                rows, size = [], 0
                for row in parse_records(data.as_py()):
                    if row["payload"] is not None:
                        row["payload_bytes"] = len(row["payload"])
                        row["payload_digest"] = base64.b32encode(hashlib.sha1(row["payload"]).digest()).decode()
                        row["payload"] = bytes(row["payload"]) if payloads else None
                        size += row["payload_bytes"] if payloads else 0
                    row["fields"] = None if row["fields"] is None else list(row["fields"].items())
                    rows.append(row)
                    if len(rows) >= 10_000 or size > 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(arrow))
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(arrow))

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(run, RECORD)


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row for each capture: request, response (or revisit) and metadata, joined through concurrent-to.

    Each record goes to the record it is concurrent to, and itself if it names none. Of several records of a kind that name
    one response, the one of the lowest id stays. Map-side aggregation joins what lies in the same archive.
    """
    columns = [c for c in records.columns if c != "fields"]
    own = F.struct("record_id", *[c for c in columns if c != "record_id"])
    lowest = lambda kinds: F.min_by(own, F.when(F.col("record_type").isin(*kinds), F.col("record_id")))
    fields = F.min_by(F.struct("record_id", "fields"), F.when(F.col("record_type") == "metadata", F.col("record_id")))
    return (records.filter(F.col("record_type").isin("request", "response", "revisit", "metadata"))
            .groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
            .agg(lowest(["request"]).alias("request"), lowest(["response", "revisit"]).alias("response"), fields.alias("metadata")))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """A row for each page: what its response holds, or for a revisit what the response that it refers to holds."""
    page = F.col("metadata.fields").getItem("page-id").cast("bigint")
    flat = materialize(captures.filter(F.col("response").isNotNull()).select(
        F.col("capture_id").alias("_capture"), page.alias("page_id"), F.col("response.record_type").alias("record_type"),
        F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.refers_to").alias("_refers")), "captures")
    answers = flat.filter(F.col("record_type") == "response").select(
        F.col("_capture").alias("_answer"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"))
    answers = measured(answers=answers.join(flat.filter(F.col("_refers").isNotNull()).select(F.col("_refers").alias("_answer")).distinct(),
                                            "_answer", "left_semi"))["answers"]
    return flat.join(answers, F.col("_refers") == F.col("_answer"), "left").select(
        "page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("_page").alias("refers_to"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as archives in the shared folder, read the archives back and assemble the captures."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    return resolve_revisits(assemble_captures(read_records(spark, path, payloads=False).drop("payload")))
