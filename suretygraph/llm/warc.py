"""WARC archives as chunked records: written as text files of segments, read back as a table of chunks.

A record's payload is cut into chunks of at most ``chunk`` bytes, rows of a record identifier and a chunk number. Each
chunk becomes one WARC segment (the first a response, the others continuation records, as WARC 1.1 has it for payloads in
parts), so no task ever shuffles, formats, writes or parses a whole large record; which page is the first with a payload is found
from ids and digests alone. A payload comes as one cell of the table, so it is its scan that takes the digest. Every segment carries the digest of its own
block; reading it back, the SHA-256 of the payload is carried on from chunk to chunk.

Files are plain or gzip text that Spark's own writer puts into any store. Segments are told apart by the line that begins
the next one: a chunk is also cut inside such a line where the payload has one itself, so that it never occurs in a block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suretygraph.llm.arrow import arrow_map, batch, longs
from suretygraph.llm.staging import stored, with_small

CHUNK = 1 << 16
#: Payloads below this size are never revisits.
LEAST = 100
_VERSION = "WARC/1.1\r\n"
_MARK = "\n" + _VERSION
_END = "\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"


def payloads(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    body = F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("body"),
    ).withColumns({"bytes": F.octet_length("body").cast("long"), "digest": F.sha2("body", 256)})


def first_pages(rows: DataFrame) -> DataFrame:
    """``digest`` and ``first``, the smallest page, of payloads of at least LEAST bytes that several pages have. Only ids, sizes
    and digests are shuffled."""
    return (
        rows.filter(F.col("bytes") >= LEAST).groupBy("digest", F.crc32("digest").alias("_split"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("first is not null and n > 1").select("digest", "first")
    )


def _cuts(body: Column, chunk: int) -> Column:
    """Begin of each chunk: every ``chunk`` bytes, and inside whatever looks like the line that begins a segment."""
    text = body.cast("string")
    ends = F.aggregate(
        F.split(text, "W(?=ARC/1[.]1\r\n)"),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("all")),
        lambda s, p: F.struct(
            (s["at"] + F.octet_length(p) + 1).cast("long").alias("at"),
            F.concat(s["all"], F.array((s["at"] + F.octet_length(p) + 1).cast("long"))).alias("all"),
        ),
        lambda s: F.slice(s["all"], 1, F.size(s["all"]) - 1),
    )
    none = F.array().cast("array<bigint>")
    long = lambda c: F.lit(c).cast("long") if isinstance(c, int) else c.cast("long")
    every = F.sequence(long(0), F.greatest(long(F.octet_length(body)) - 1, long(0)), long(chunk))
    return F.array_sort(F.array_distinct(F.concat(every, F.when(text.contains(_VERSION), ends).otherwise(none))))


def chunks(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of a payload: ``record``, ``number`` from 1, ``of`` (how many), ``block``. No payload is shuffled
    before it is cut."""
    cut = rows.withColumn("cuts", _cuts(F.col("body"), chunk))
    return cut.select(
        "*", F.size("cuts").alias("of"), F.posexplode("cuts").alias("number", "begin")
    ).select(
        "*", F.coalesce(F.get("cuts", F.col("number") + 1), F.octet_length("body").cast("long")).alias("end")
    ).select(
        "record", "page_id", "url", "bytes", "digest", "of", (F.col("number") + 1).alias("number"),
        F.substring("body", F.col("begin").cast("int") + 1, (F.col("end") - F.col("begin")).cast("int")).alias("block"),
    )


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null. Controls and line ends in values are percent-encoded."""
    text = value.cast("string")
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "%", "%25"), "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(name + ": "), plain, F.lit("\r\n")), F.lit(""))


def segment_text(chunk_rows: DataFrame) -> DataFrame:
    """One column ``value``: each chunk as a WARC record without the line ends that close it."""
    first = F.col("number") == 1
    value = F.concat(
        F.lit(_VERSION),
        _header("WARC-Type", F.when(first, F.col("kind")).otherwise("continuation")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:x-page:"), F.col("record"), F.lit("/"), F.col("number"), F.lit(">"))),
        _header("WARC-Date", F.lit(_DATE)),
        _header("WARC-Target-URI", F.col("url")),
        _header("X-Page-ID", F.col("page_id")),
        _header("WARC-Refers-To", F.when(F.col("kind") == "revisit", F.col("first"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("X-Payload-Length", F.col("bytes")),
        _header("WARC-Segment-Number", F.col("number")),
        _header("X-Segments", F.col("of")),
        _header("X-Record", F.col("record")),
        _header("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("block", 256))),
        _header("Content-Length", F.octet_length("block")),
        F.lit("\r\n"), F.col("block").cast("string"),
    )
    return chunk_rows.select(value.alias("value"))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    chunk: int = CHUNK, compression: str = "gzip",
) -> None:
    """Writes a record for each row. Of rows with equal payloads of at least LEAST bytes those with the smallest id are
    responses, the others revisits without a payload. A null id is larger than all others: such rows revisit a row with
    an id, and are responses where there is none. A null body is an empty payload. Repeated rows are records of their own.
    """
    rows = payloads(pages, id_col, url_col, body_col)
    firsts = stored(first_pages(rows.select("page_id", "bytes", "digest")), "firsts")
    named = rows.withColumn("record", F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit("-"), F.monotonically_increasing_id()))
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    # The chunks are what is joined, never whole payloads. Of a revisit one is left, without its bytes.
    cut = with_small(chunks(named, chunk), firsts, "digest", "left").withColumn("_again", F.coalesce(revisit, F.lit(False)))
    kept = cut.filter(~F.col("_again") | (F.col("number") == 1)).withColumns({
        "kind": F.when(F.col("_again"), "revisit").otherwise("response"),
        "block": F.when(F.col("_again"), F.lit("").cast("binary")).otherwise(F.col("block")),
        "of": F.when(F.col("_again"), 1).otherwise(F.col("of")),
    })
    segment_text(kept).write.option("lineSep", _END).option("compression", compression).text(folder)


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk table of the archives in a folder; a block that fails its digest or length is an error."""
    lines = spark.read.option("lineSep", _MARK).text(folder)
    value = F.col("value")
    text = F.when(value.startswith(_VERSION), F.substring(value, F.lit(len(_VERSION) + 1), F.length(value))).otherwise(value)
    at = F.instr(text, _END)
    head = F.concat(F.lit("\r\n"), F.substring(text, F.lit(1), at - 1), F.lit("\r\n"))
    parts = lines.filter(F.length("value") > 0).select(head.alias("head"), F.octet_length(F.substring(text, F.lit(1), at - 1)).alias("n"), text.cast("binary").alias("raw"))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", "\r\n" + name + ": ([^\r\n]*)\r\n", 1)
        return F.when(F.col("head").contains("\r\n" + name + ": "), found)

    size = field("Content-Length").cast("int")
    block = F.substring("raw", F.col("n") + len(_END) + 1, size)
    plain = lambda c: F.replace(F.replace(F.replace(c, F.lit("%0A"), F.lit("\n")), F.lit("%0D"), F.lit("\r")), F.lit("%25"), F.lit("%"))
    rows = parts.select(
        field("X-Record").alias("record"), field("X-Page-ID").cast("long").alias("page_id"),
        plain(field("WARC-Target-URI")).alias("url"), field("WARC-Type").alias("kind"),
        field("WARC-Refers-To").cast("long").alias("refers_to"),
        F.substring(field("WARC-Payload-Digest"), 8, 64).alias("digest"), field("X-Payload-Length").cast("long").alias("bytes"),
        field("WARC-Segment-Number").cast("int").alias("number"), field("X-Segments").cast("int").alias("of"),
        F.substring(field("WARC-Block-Digest"), 8, 64).alias("block_digest"), size.alias("size"), block.alias("block"),
    )
    wrong = (F.octet_length("block") != F.col("size")) | (F.sha2("block", 256) != F.col("block_digest"))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("damaged segment of record "), F.col("record")))).otherwise(F.col("block"))
    return rows.withColumn("block", checked).drop("block_digest", "size")


def _digests(batches):
    """Carries the hash of the open record over rows sorted by record and chunk, and over batches."""
    record, state, size, last = None, None, 0, None

    def closed():
        return batch(record=pa.array([record]), bytes=longs(np.array([size])), digest=pa.array([state.hexdigest()]), chunks=pa.array([last], pa.int32()))

    for b in batches:
        for name, number, block in zip(b["record"], b["number"], b["block"]):
            if name.as_py() != record:
                if record is not None:
                    yield closed()
                record, state, size = name.as_py(), hashlib.sha256(), 0
            view = memoryview(block.as_buffer())
            state.update(view)
            size, last = size + len(view), number.as_py()
    if record is not None:
        yield closed()


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record of the archives: ``page_id``, ``url``, ``kind``, ``refers_to``, ``payload_bytes``,
    ``payload_digest``. Size and digest of responses are those of the bytes read, and must be those the record names;
    revisits have those of the payload they refer to."""
    rows = read_chunks(spark, folder)
    columns = ["record", "page_id", "url", "kind", "refers_to", "digest", "bytes"]
    single = rows.filter("of = 1").select(
        *columns, F.octet_length("block").cast("long").alias("read_bytes"), F.sha2("block", 256).alias("read_digest"))
    several = rows.filter("of > 1")
    sums = arrow_map(
        several.select("record", "number", "block").repartition("record").sortWithinPartitions("record", "number"),
        _digests, "record string, bytes long, digest string, chunks int",
    ).select("record", F.col("bytes").alias("read_bytes"), F.col("digest").alias("read_digest"))
    joined = several.filter("number = 1").select(columns).join(sums, "record").select(*columns, "read_bytes", "read_digest")
    whole = single.union(joined)
    wrong = (F.col("kind") == "response") & ((F.col("digest") != F.col("read_digest")) | (F.col("bytes") != F.col("read_bytes")))
    digest = F.when(wrong, F.raise_error(F.concat(F.lit("damaged record "), F.col("record")))).otherwise(F.col("digest"))
    return whole.select("record", "page_id", "url", "kind", "refers_to", F.col("bytes").alias("payload_bytes"), digest.alias("payload_digest"))
