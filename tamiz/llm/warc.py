"""WARC archives: written from pages, read back, and assembled into one nested row per capture.

Method: transaction assembly. A capture is stored as three records: the response (or a revisit that refers to an earlier
response with the same payload), the request, and metadata. Request and metadata name the response's record in
WARC-Concurrent-To. Reading parses all records and joins them through these identifiers, in whichever of the two records they
stand, into one row per capture with its requests and metadata nested. A revisit finds its payload's size through WARC-Refers-To.

Archives are gzip files, one per writing task, made by Spark's text writer with the record separator as line end; thus they are
written and read wherever Spark can. A record's blank lines cut it into pieces, which one task reads in order and puts together by Content-Length.
A record that ends elsewhere than its length says is reported as type `unreadable` with its text, and reading goes on at the next
one. Files must be compressed, as uncompressed ones would be split among tasks; one that begins inside a record raises an error.

Null or empty texts are empty payloads. Of pages with one payload of `least` bytes or more the smallest page_id is the response, a missing id
after all others, then the smallest url; of rows that agree in all columns one is. Each row is a capture, also repeated ones. An
empty table gives an archive without records. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import staged
from tamiz.queries.base import table
from tamiz.runtime import null_safe_join, work_dir

LEAST_BYTES = 100
SEPARATOR = "\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY = ["digest", "page_id", "url"]


def urn(seed: Column) -> Column:
    """A record identifier in the form of a UUID, from the MD5 of the seed."""
    hexed = F.md5(seed.cast("binary"))
    parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def response_id(digest: Column) -> Column:
    """The record of the one response that revisits of a payload refer to."""
    return urn(F.concat(F.lit("payload "), digest))


def classified(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, digest, bytes of every page, `revisit`, and `shared`: whether others revisit it."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("bytes"),
    )
    # Copies are counted before the shuffle; texts move only to be joined with their payload's first page.
    same = rows.filter(F.col("bytes") >= least).groupBy(*KEY).agg(F.count("*").alias("n"))
    ranked = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url", "n")
    firsts = same.groupBy("digest").agg(F.min(ranked).alias("_first"), F.sum("n").alias("_all")).filter("_all > 1")
    firsts = staged(firsts, "warc-firsts")
    own = F.col("page_id").eqNullSafe(F.col("_first.page_id")) & F.col("url").eqNullSafe(F.col("_first.url"))
    long = F.col("bytes") >= least
    joined = rows.join(firsts.withColumnRenamed("digest", "_digest"), (F.col("digest") == F.col("_digest")) & long, "left")
    once = joined.filter(F.col("_first").isNull() | ~own | (F.col("_first.n") == 1)).select(
        "page_id", "url", F.when(F.col("_first").isNull() | own, F.col("html")).alias("html"), "digest", "bytes",
        (F.col("_first").isNotNull() & ~own).alias("revisit"), F.col("_first").isNotNull().alias("shared"),
    )
    # Rows that agree in all columns with their payload's first page: one is the response.
    several = firsts.filter("_first.n > 1").select("digest", F.col("_first.page_id").alias("page_id"), F.col("_first.url").alias("url"))
    tied = null_safe_join(rows, several, KEY)
    numbered = staged(tied.select(*KEY, "bytes").withColumn("_row", F.monotonically_increasing_id()), "warc-tied")
    lead = numbered.groupBy("digest").agg(F.min("_row").alias("_lead"))
    again = numbered.join(lead, "digest").filter("_row <> _lead").select(
        "page_id", "url", F.lit(None).cast("string").alias("html"), "digest", "bytes",
        F.lit(True).alias("revisit"), F.lit(True).alias("shared"),
    )
    one = tied.groupBy(*KEY, "bytes").agg(F.first("html").alias("html")).select(
        "page_id", "url", "html", "digest", "bytes", F.lit(False).alias("revisit"), F.lit(True).alias("shared")
    )
    return once.unionByName(again).unionByName(one)


def record(kind: str | Column, record_id: Column, fields: list[tuple[str, Column]], mime: str, block: Column) -> Column:
    """A record's text, without the separator at its end. Fields that are null are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    given = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(DATE)), *fields, ("Content-Type", F.lit(mime))]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in given]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines, size), F.lit(SEPARATOR), block)


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Write the captures of all pages below `path`; see the module for what becomes of copies."""
    rows = classified(pages, least)
    lead = F.col("shared") & ~F.col("revisit")
    # Records refer to each other within a row, but for revisits, which name their payload's response.
    known = rows.withColumn("_id", F.when(lead, response_id(F.col("digest"))).otherwise(urn(F.uuid())))
    # A generator keeps the identifiers from being drawn again for each use.
    drawn = known.select("*", F.explode(F.array(F.struct(F.col("_id").alias("own"), urn(F.uuid()).alias("ask"), urn(F.uuid()).alias("meta")))).alias("_ids"))
    target = ("WARC-Target-URI", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    head = F.concat(F.lit(HTTP), F.col("bytes").cast("string"), F.lit(SEPARATOR))
    own, concurrent = F.col("_ids.own"), ("WARC-Concurrent-To", F.col("_ids.own"))
    response = record("response", own, [target, digest], "application/http; msgtype=response", F.concat(head, F.col("html")))
    to = [("WARC-Refers-To", response_id(F.col("digest"))), ("WARC-Profile", F.lit(PROFILE))]
    revisit = record("revisit", own, [target, digest, *to], "application/http; msgtype=response", head)
    asked = F.lit("GET / HTTP/1.1\r\nAccept: text/html\r\n\r\n")
    request = record("request", F.col("_ids.ask"), [target, concurrent], "application/http; msgtype=request", asked)
    shown = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("fetched: yes\r\n"))
    metadata = record("metadata", F.col("_ids.meta"), [target, concurrent], "application/warc-fields", shown)
    texts = F.explode(F.array(request, F.when(F.col("revisit"), revisit).otherwise(response), metadata))
    drawn.select(texts.alias("value")).write.option("lineSep", SEPARATOR).option("compression", "gzip").text(path)


RECORDS = (
    "record_id string, type string, target string, concurrent array<string>, refers_to string, declared_digest string, "
    "date string, fields map<string,string>, payload_bytes long, payload_digest string, payload binary"
)


def named_fields(raw: bytes) -> list[tuple[str, str]]:
    """The `name: value` lines of a header, names in lower case."""
    made = []
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        name, mark, value = line.partition(":")
        if mark:
            made.append((name.strip().lower(), value.strip()))
    return made


def parsed(header: bytes, block: bytes) -> dict:
    """One record. The payload of an HTTP message is what follows its header, else the block."""
    given = named_fields(header)
    first = dict(reversed(given))
    kind = first.get("warc-type", "unreadable")
    http = first.get("content-type", "").startswith("application/http")
    payload = block.partition(SEPARATOR.encode())[2] if http else block
    return {
        "record_id": first.get("warc-record-id"), "type": kind, "target": first.get("warc-target-uri"),
        "concurrent": [v for n, v in given if n == "warc-concurrent-to"], "refers_to": first.get("warc-refers-to"),
        "declared_digest": first.get("warc-payload-digest"), "date": first.get("warc-date"),
        "fields": named_fields(block) if kind == "metadata" else None, "payload_bytes": len(payload),
        "payload_digest": hashlib.sha256(payload).hexdigest(), "payload": payload,
    }


def unreadable(text: bytes) -> dict:
    return dict.fromkeys(c.split()[0] for c in RECORDS.split(", ")) | {"type": "unreadable", "payload": text, "concurrent": []}


def length_of(header: bytes) -> int | None:
    """The length a header declares; None if it is no readable header."""
    if not header.startswith(b"WARC/"):
        return None
    size = dict(named_fields(header)).get("content-length", "")
    return int(size) if size.isascii() and size.isdigit() else None


def records_of(pieces: Iterator[bytes]) -> Iterator[dict]:
    """The records of one file from the pieces between its blank lines. A block may end with line ends of its own, so
    that pieces need not end where records do."""
    cut, data, first = SEPARATOR.encode(), b"", True

    def more(least: int) -> bytes:
        held, size = [data], len(data)
        while size < least and (piece := next(pieces, None)) is not None:
            held += (piece, cut)
            size += len(piece) + len(cut)
        return b"".join(held)

    while data := more(1):
        while cut not in data and len(longer := more(len(data) + 1)) > len(data):
            data = longer
        header, _, data = data.partition(cut)
        header = header.lstrip(b"\r\n")
        if first and not header.startswith(b"WARC/"):
            raise ValueError("an archive begins inside a record: is it compressed?")
        first, size = False, length_of(header)
        if size is None:
            if header:
                yield unreadable(header)
            continue
        data = more(size + len(cut))
        if len(data) >= size and data[size : size + len(cut)] in (cut, b""):
            yield parsed(header, data[:size])
            data = data[size + len(cut) :]
        else:
            # The declared length is wrong: go on at the next header.
            at = data.find(cut + b"WARC/")
            at = len(data) if at < 0 else at
            yield unreadable(header + cut + data[:at])
            data = data[at + len(cut) :]


BATCH_BYTES = 8 << 20


def batched(records: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in records:
        held.append(r)
        size += 512 + len(r["payload"] or b"")
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the compressed archives below `path`, one row each; without `payloads` these are null."""
    strings = pa.list_(pa.string())
    kinds = {"concurrent": strings, "fields": pa.map_(pa.string(), pa.string()), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in (c.split()[0] for c in RECORDS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched((r if payloads or r["type"] == "unreadable" else r | {"payload": None} for r in of_files(batches)), schema)

    pieces = spark.read.option("lineSep", SEPARATOR).text(path)
    named = pieces.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    return named.mapInArrow(run, RECORDS)


def of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The records of a task's files, which come one after the other."""
    rows = (row for b in batches for row in zip(b.column("file").to_pylist(), b.column("piece").to_pylist(), strict=True))
    ahead = next(rows, None)
    while ahead is not None:
        file = ahead[0]

        def own():
            nonlocal ahead
            while ahead is not None and ahead[0] == file:
                piece = ahead[1]
                ahead = next(rows, None)
                yield piece

        yield from records_of(own())


def captures(records: DataFrame) -> DataFrame:
    """One row per response or revisit: record_id, type, target, refers_to, date, payload_bytes, payload_digest, payload, and
    `requests` and `metadata`, arrays of the records that name it, or that it names, in WARC-Concurrent-To."""
    main = records.filter("type IN ('response', 'revisit')")
    about = records.filter("type IN ('request', 'metadata')")
    named = about.select("record_id", F.explode("concurrent").alias("capture"))
    naming = main.select(F.explode("concurrent").alias("record_id"), F.col("record_id").alias("capture"))
    links = named.union(naming).distinct()
    # Both sides of each join have one row per record, so no key is heavy.
    told = about.select("record_id", "type", "date", "fields", "payload_bytes").join(links, "record_id")
    entry = F.struct("record_id", "date", "fields", "payload_bytes")
    grouped = told.groupBy("capture").agg(
        F.array_sort(F.collect_list(F.when(F.col("type") == "request", F.struct("record_id", "date", "payload_bytes")))).alias("requests"),
        F.collect_list(F.when(F.col("type") == "metadata", entry)).alias("metadata"),
    )
    joined = main.join(grouped, main["record_id"] == grouped["capture"], "left").drop("capture", "concurrent", "fields")
    return joined.withColumns({
        "requests": F.coalesce("requests", F.array().cast("array<struct<record_id:string,date:string,payload_bytes:bigint>>")),
        "metadata": F.coalesce("metadata", F.array().cast("array<struct<record_id:string,date:string,fields:map<string,string>,payload_bytes:bigint>>")),
    })


def op12_transaction_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, read back and assembled."""
    path = work_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    records = staged(read_records(spark, path, payloads=False), "warc-records")
    found = staged(
        captures(records).select(
            "record_id", "type", "refers_to", "payload_bytes", "payload_digest", "declared_digest",
            F.get("metadata", F.lit(0))["fields"]["page-id"].cast("long").alias("page_id"),
        ),
        "warc-captures",
    )
    full = found.filter("type = 'response'").select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    first = found.filter("type = 'response'").select(
        F.col("record_id").alias("_first"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"),
    )
    again = found.filter("type = 'revisit'").join(first, F.col("refers_to") == F.col("_first")).select(
        "page_id", F.col("_bytes").alias("payload_bytes"), F.regexp_extract("declared_digest", "^sha256:(.*)$", 1).alias("payload_digest"),
        F.lit("revisit").alias("record_type"), F.col("_page").alias("refers_to"),
    )
    return full.unionByName(again)


OP12_SQL = """
WITH p AS (
    SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
r AS (
    SELECT *, row_number() OVER w AS place, first(page_id) OVER w AS head FROM p
    WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN head END AS refers_to
FROM r
"""
