"""Raw landing documents: one JSON envelope per key and batch with parallel hourly arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.fixed_values import HOURLY_VARIABLES
from tamiz.operators.latest import keep_latest, newest_first
from tamiz.runtime import checkpoint, computed_once
from tamiz.sinks.tables import path_exists

LANDING_FOLDERS = ["ciudad", "fecha_ingesta"]
# Holds the text of a document that is not JSON.
UNREAD = "_documento"


def body_type(variables: Sequence[str] = HOURLY_VARIABLES) -> T.StructType:
    hourly = T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    )
    return T.StructType([T.StructField("hourly", hourly)])


def envelope_type(variables: Sequence[str] = HOURLY_VARIABLES) -> T.StructType:
    names = ("id_lote", "timestamp_ingesta_utc", "ciudad", "origen")
    metadata = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return T.StructType(
        [T.StructField("metadata", metadata), T.StructField("datos_api", body_type(variables))]
    )


def landed_type(variables: Sequence[str] = HOURLY_VARIABLES) -> T.StructType:
    """The envelope with the text of a document that cannot be read."""
    return T.StructType([*envelope_type(variables), T.StructField(UNREAD, T.StringType())])


def read_envelopes(
    spark: SparkSession,
    paths: Sequence[str],
    variables: Sequence[str] = HOURLY_VARIABLES,
    since: str | None = None,
) -> DataFrame:
    """All envelopes of the files below `paths`, however they are laid out; no paths give an empty frame.

    A file may hold one indented document, a document in each line, or several of either kind; it is
    read a document at a time. `since` (an ISO day) reads only the later fecha_ingesta= folders of a landing area.
    """
    if not paths:
        empty = spark.createDataFrame([], landed_type(variables))
        return empty.withColumn("path", F.lit(None).cast("string"))
    reader = spark.read.option("lineSep", DOCUMENT_BREAK)
    if since is not None:
        folders = ", ".join(f"{n} string" for n in LANDING_FOLDERS)
        files = reader.schema(f"value string, {folders}").text(list(paths))
        files = files.filter(F.col("fecha_ingesta") >= since)
    else:
        files = reader.option("recursiveFileLookup", "true").text(list(paths))
    return envelopes_of(files, variables)


# Between two documents: the end of a line and the brace of a document that begins. Records read with
# this as `lineSep` hold one document at most with what stands after it, so no file is held whole.
DOCUMENT_BREAK = "\n{"
# Files whose size is not that of their text.
CODECS = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".passthrough")
RECORDS_BYTES = 4 << 20


def whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: records parted at DOCUMENT_BREAK with the line feed and brace the reader took from them.

    The records of a file's block come in order. The first of a file has all its bytes; the last one
    is followed by nothing. Blank records between documents are left out, a file of blanks is kept.
    A lone brace at the end of a file is a document cut short, of which the reader shows nothing; it is
    told by the file's size, if the file is read as one block.
    """
    names, kinds = ["value", "path"], [pa.binary(), pa.string()]

    def plain(path: str) -> bool:
        return not path.lower().endswith(CODECS)

    def told(block: tuple, value: bytes, first: bool, last: bool, read: int) -> Iterator[bytes]:
        path, start, length, size = block
        # The last record of a block may reach over all that follows.
        ends = last and len(value) >= size - start - length
        lone = ends and start == 0 and length == size == read and plain(path)
        text = (value if first else b"{" + value) + (b"" if ends and not lone else b"\n")
        if text.strip() or first and ends and not lone:
            yield text
        if lone:
            yield b"{"

    def rows() -> Iterator[tuple[bytes, str]]:
        # The record before, as its place in the block shows with the next one.
        block, value, first, read = None, b"", False, 0
        for batch in batches:
            for record, *now in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                # A file that is given twice begins anew when all its bytes have been read.
                over = block is not None and block[1] == 0 and read >= block[3] and plain(block[0])
                if tuple(now) == block and not over:
                    yield from ((text, block[0]) for text in told(block, value, first, False, read))
                    value, first, read = record, False, read + len(record) + len(DOCUMENT_BREAK)
                    continue
                if block is not None:
                    yield from ((text, block[0]) for text in told(block, value, first, True, read))
                block, value = tuple(now), record
                first, read = block[1] == 0, len(record) + len(DOCUMENT_BREAK)
        if block is not None:
            yield from ((text, block[0]) for text in told(block, value, first, True, read))

    held, size = ([], []), 0
    for text, path in rows():
        held[0].append(text)
        held[1].append(path)
        size += len(text) + len(path)
        if size >= RECORDS_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds, strict=True)], names=names)
            held, size = ([], []), 0
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds, strict=True)], names=names)


# A line that is a whole document or closes an indented one ends a document; a brace at the
# start of a line begins one. Only line feeds end lines, as JSON texts may hold other separators.
DOCUMENT_END = r"(?md)^(\{.*\}|\})[ \t\r]*$"
DOCUMENT_START = r"(?md)^\{"
BORDER = "\x01"


def split_documents(text: Column) -> Column:
    """The JSON documents in a file's text or a record of it, and whatever stands between them. A file of
    blanks is one document; files without any byte are skipped by the reader."""
    ended = F.regexp_replace(text, DOCUMENT_END, f"$1{BORDER}")
    pieces = F.split(F.regexp_replace(ended, DOCUMENT_START, f"{BORDER}{{"), BORDER, -1)
    shown = F.filter(pieces, lambda piece: piece.rlike(r"\S"))
    return F.when(F.size(shown) > 0, shown).otherwise(F.array(text))


def document_texts(files: DataFrame) -> DataFrame:
    """The text (`_piece`) of every document, and of whatever stands between them, with its path."""
    place = [F.col(f"_metadata.{name}") for name in ("file_path", "file_block_start", "file_block_length", "file_size")]
    # As bytes, which need not be valid UTF-8.
    records = files.select(F.col("value").cast("binary"), *place).mapInArrow(whole_records, "value binary, path string")
    return records.select(F.explode(split_documents(F.col("value").cast("string"))).alias("_piece"), "path")


def envelopes_of(files: DataFrame, variables: Sequence[str] = HOURLY_VARIABLES) -> DataFrame:
    """Envelopes with their path from files read as text with DOCUMENT_BREAK as `lineSep`, batch or stream.

    A document that does not fit the envelope, is cut short or goes on after its end keeps its text in `UNREAD`.
    """
    schema, pieces = landed_type(variables), document_texts(files)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREAD}
    parsed = computed_once(pieces, {"_envelope": F.from_json("_piece", schema, options)})
    envelope = F.col("_envelope")
    closed = F.rtrim(F.regexp_replace("_piece", r"\s+$", "")).endswith("}")
    unread = F.when(envelope.isNull() | envelope[UNREAD].isNotNull() | ~closed, F.col("_piece"))
    names = [f.name for f in schema if f.name != UNREAD]
    return parsed.select(*[envelope[n].alias(n) for n in names], unread.alias(UNREAD), "path")


def landing_folders(spark: SparkSession, raw: str) -> dict[str, list[str]]:
    """The day folders of each city in a landing area, newest first; only folder names are read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(raw)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    city, day = (f"{n}=" for n in LANDING_FOLDERS)
    found: dict[str, list[str]] = {}
    for folder in files.listStatus(path) if files.exists(path) else []:
        name = folder.getPath().getName()
        if name.startswith(city):
            days = [d.getPath() for d in files.listStatus(folder.getPath())]
            days = [(d.getName(), d.toString()) for d in days if d.getName().startswith(day)]
            found[unquote(name.removeprefix(city))] = [p for _, p in sorted(days, reverse=True)]
    return found


def newest_usable(
    spark: SparkSession, raw: str, cities: Sequence[str] | None = None, since: str | None = None,
    variables: Sequence[str] = HOURLY_VARIABLES,
) -> tuple[DataFrame, DataFrame]:
    """(the newest usable envelope of each city, with `ciudad`; the rejected documents of the folders read).

    Day folders are opened newest first, for the cities that have none yet, twice as many days in each round; older
    ones stay closed. `cities` limits the search, None takes all that have landed. An area without city folders is
    read whole.
    """
    folders = landing_folders(spark, raw)
    if not folders:
        usable, rejected = split_envelopes(read_envelopes(spark, [raw] if cities != [] and path_exists(spark, raw) else [], variables), variables)
        wanted = usable if cities is None else usable.filter(F.col("metadata.ciudad").isin(list(cities)))
        return checkpoint(latest_batch(wanted)), rejected
    if since is not None:
        first = f"{LANDING_FOLDERS[1]}={since}"
        folders = {c: [d for d in days if d.rstrip("/").rsplit("/", 1)[-1] >= first] for c, days in folders.items()}
    missing = [c for c in (folders if cities is None else cities) if folders.get(c)]
    start, step = 0, 1
    usable, rejected = split_envelopes(read_envelopes(spark, [], variables), variables)
    newest = latest_batch(usable)
    while missing:
        opened = [d for c in missing for d in folders[c][start : start + step]]
        usable, unusable = split_envelopes(checkpoint(read_envelopes(spark, opened, variables)), variables)
        found = checkpoint(latest_batch(usable.filter(F.col("metadata.ciudad").isin(missing))))
        newest, rejected = newest.unionByName(found), rejected.unionByName(unusable)
        there = {r.ciudad for r in found.select("ciudad").collect()}
        start, step = start + step, 2 * step
        missing = [c for c in missing if c not in there and len(folders[c]) > start]
    return newest, rejected


def has_series(body: Column) -> Column:
    """Shape check: the body has an hourly section with a non-empty time array."""
    return F.coalesce(F.size(body["hourly"]["time"]) > 0, F.lit(False))


def lengths_differ(variables: Sequence[str]) -> Column:
    hourly, differ = F.col("datos_api.hourly"), F.lit(False)
    for v in variables:
        differ = differ | ~F.size(hourly[v]).eqNullSafe(F.size(hourly["time"]))
    return differ


def split_envelopes(
    envelopes: DataFrame, variables: Sequence[str] = HOURLY_VARIABLES
) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected) documents. Every rejected one keeps its reason, path and text.

    A document is rejected if it is not JSON, has no hours, or its arrays differ in length.
    """
    unread = F.col(UNREAD) if UNREAD in envelopes.columns else F.lit(None).cast("string")
    reason = (
        F.when(unread.isNotNull(), "unreadable document")
        .when(~has_series(F.col("datos_api")), "no hourly series")
        .when(lengths_differ(variables), "hourly arrays differ in length")
    )
    judged = envelopes.withColumn("motivo_rechazo", reason)
    rejected = judged.filter("motivo_rechazo IS NOT NULL").select(
        "motivo_rechazo",
        "path",
        F.coalesce(unread, F.to_json(F.struct("metadata", "datos_api"))).alias("documento"),
    )
    return judged.filter("motivo_rechazo IS NULL").drop("motivo_rechazo"), rejected


def flatten_envelopes(
    envelopes: DataFrame, variables: Sequence[str] = HOURLY_VARIABLES
) -> DataFrame:
    """One row per hour with the batch's metadata repeated. Array lengths must agree."""
    hourly = F.col("datos_api.hourly")
    zipped = F.arrays_zip(
        hourly["time"].alias("time"), *[hourly[v].alias(v) for v in variables]
    )
    hours = F.when(
        lengths_differ(variables),
        F.raise_error(F.concat(F.lit("hourly arrays differ in length: "), "metadata.ciudad")),
    ).otherwise(zipped)
    rows = envelopes.select("metadata", F.explode(hours).alias("hour"))
    return rows.select(
        F.col("metadata.ciudad").alias("ciudad"),
        F.col("hour.time").alias("fecha_hora_utc"),
        *[F.col("hour")[v].alias(v) for v in variables],
        F.col("metadata.id_lote").alias("id_lote"),
        F.col("metadata.origen").alias("origen"),
        F.col("metadata.timestamp_ingesta_utc").alias("timestamp_ingesta_utc"),
    )


def latest_batch(envelopes: DataFrame) -> DataFrame:
    """Newest envelope per key by the ingest time stored inside, then the batch id."""
    stamped = envelopes.select(
        "*", "metadata.ciudad", "metadata.timestamp_ingesta_utc", "metadata.id_lote"
    )
    newest = keep_latest(stamped, ["ciudad"], newest_first("timestamp_ingesta_utc", "id_lote", "path"))
    return newest.drop("timestamp_ingesta_utc", "id_lote")


def existing_batches(requested: DataFrame, envelopes: DataFrame) -> DataFrame:
    """Ingest summary from what already landed: requested keys with path and origin."""
    found = latest_batch(envelopes).select("ciudad", "path")
    origin = F.when(F.col("path").isNull(), "SIN_DATOS").otherwise("BRONZE_EXISTENTE")
    return requested.select("ciudad").join(found, "ciudad", "left").withColumn("origen", origin)


def arbitrate_origin(
    requested: DataFrame, fetched: DataFrame, envelopes: DataFrame, batch: str, stamped: str
) -> DataFrame:
    """Per requested key: the fetched body if usable, else the newest landed one, else none.

    `fetched` has ciudad and datos_api. A fallback body is stamped with the new batch,
    so it counts as the most recent one later on.
    """
    fresh = fetched.select("ciudad", F.col("datos_api").alias("_new"))
    previous = latest_batch(envelopes).select("ciudad", F.col("datos_api").alias("_old"))
    joined = (
        requested.select("ciudad").join(fresh, "ciudad", "left").join(previous, "ciudad", "left")
    )
    usable = has_series(F.col("_new"))
    return joined.select(
        "ciudad",
        F.when(usable, "API")
        .when(F.col("_old").isNotNull(), "FALLBACK")
        .otherwise("SIN_DATOS")
        .alias("origen"),
        F.lit(batch).alias("id_lote"),
        F.lit(stamped).alias("timestamp_ingesta_utc"),
        F.when(usable, F.col("_new")).otherwise(F.col("_old")).alias("datos_api"),
    )


def as_envelopes(arbitrated: DataFrame) -> DataFrame:
    """Envelopes to land; keys without data are left out."""
    return arbitrated.filter(F.col("origen") != "SIN_DATOS").select(
        F.struct("id_lote", "timestamp_ingesta_utc", "ciudad", "origen").alias("metadata"),
        "datos_api",
    )


def origin_counts(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count_if(F.col("origen") == "API").alias("from_api"),
        F.count_if(F.col("origen") == "FALLBACK").alias("from_fallback"),
        F.count_if(F.col("origen") == "SIN_DATOS").alias("without_data"),
    )
