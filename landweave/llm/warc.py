"""WARC archives: records are indexed by archive, offset and length before any is read, and selected ones are read by merged byte ranges."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .codec import codec_dictionary, packers
from .storage import shared_dir, written

LEAST_REVISIT, ARCHIVE_BYTES, GAP, RANGE_BYTES = 1000, 16 << 20, 64 << 10, 4 << 20
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"


def record_id(page: str, digest: str) -> Column:
    return F.concat(F.lit("<urn:sha1:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit("-"), F.col(digest), F.lit(">"))


def _packed(dictionary: bytes | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, _ = packers(dictionary, 3)
        for batch in T.chunks(batches, column="html"):
            data, offsets = T.raw(batch.column(2))
            blob, at = data.tobytes(), offsets.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([pack(blob[a:b]) for a, b in zip(at, at[1:], strict=False)], pa.binary()), *batch.columns[3:]], batch.schema.names)

    return run


def _bodies(dictionary: bytes | None):
    """What is written of each record: the head and, of responses, the payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, unpack = packers(dictionary)
        for batch in T.chunks(batches, 1 << 20, "packed"):
            rows = batch.to_pydict()
            value = [h if kind == "revisit" else h + unpack(x).decode() for h, x, kind in zip(rows["head"], rows["packed"], rows["record_type"], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(4)] + [pa.array(value)], ["archive", *ORDER, "value"])

    return run


def records(pages: DataFrame, archives: int, least: int = LEAST_REVISIT, packed: Callable | None = None) -> DataFrame:
    """The archive and head of each record; ``packed``: with its html, compressed by that. Rows of an archive share a partition."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")
    ).select("*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha1(F.encode("html", "utf-8")).alias("payload_digest"))
    large = rows.filter(F.col("payload_bytes") >= least).select("page_id", "payload_digest", "payload_bytes")
    kept = large.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    revisits = large.join(kept, ["payload_digest", "payload_bytes"]).filter("NOT page_id <=> refers_to").select("page_id", "payload_digest", "refers_to").distinct()
    none = lambda kind: F.lit(None).cast(kind)
    if packed:
        rows = rows.mapInArrow(packed, "page_id long, url string, packed binary, payload_bytes long, payload_digest string")
    else:
        rows = rows.drop("html")
    marked = rows.withColumn("refers_to", none("long")).unionByName(revisits, allowMissingColumns=True)
    marked = marked.withColumn("archive", F.pmod(F.xxhash64("page_id", "payload_digest"), F.lit(archives))).repartition(archives, "archive")
    same = Window.partitionBy("archive", "page_id", "payload_digest")
    marked = marked.withColumn("refers_to", F.max("refers_to").over(same)).filter("url IS NOT NULL")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.octet_length("http") + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), record_id("page_id", "payload_digest"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", " "),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "), record_id("refers_to", "payload_digest"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), block.cast("string"), F.lit(END), F.col("http"),
    )
    return marked.withColumn("http", http).withColumn("head", head).drop("http").withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))


ORDER = ["page_id", "payload_digest", "url"]


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a WARC record per row and returns the index: page_id, url, archive path, offset, length, payload digest, record type, refers_to.

    Of records with equal payloads of ``least`` bytes or more, the one with the largest page_id is the response and the others revisit it.
    A null html is an empty payload, a null url an empty one. Rows of one page_id with equal payloads are alike: all responses, or all
    revisits. Rows with a null page_id revisit a page that has an id and never stand for others. Empty input: an empty index, no archives.
    Archives are text files of Spark's own writer, whose line separator ends a record, so a lost executor's file is written anew and whole.
    Html is shuffled once, compressed with a dictionary of at most 1,000 page starts, by archive; which payloads are equal is found on digests alone.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    archives = max(1, math.ceil(total / archive_bytes))
    dictionary = codec_dictionary(pages, "html")
    whole, rows = records(pages, archives, least, _packed(dictionary)), records(pages, archives, least)
    # The order within a file is that of the offsets below: rows that tie in all of ORDER are equal records.
    (
        whole.select("archive", *ORDER, "head", "packed", "record_type")
        .mapInArrow(_bodies(dictionary), "archive long, page_id long, payload_digest string, url string, value string")
        .sortWithinPartitions("archive", *ORDER)
        .select("archive", "value")
        .write.partitionBy("archive").option("lineSep", END).text(folder)
    )
    size = F.octet_length("head") + F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes"))
    before = Window.partitionBy("archive").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    index = (
        rows.select("archive", *ORDER, "record_type", "refers_to", (size + len(END)).cast("long").alias("length"))
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    )
    if not total and pages.isEmpty():
        return index.withColumn("path", F.lit("")).drop("archive")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(folder)
    files = files.select("path", F.regexp_extract("path", r"/archive=(\d+)/", 1).cast("long").alias("archive"))
    return written(index.join(files, "archive").select("page_id", "url", "path", "offset", "length", "payload_digest", "record_type", "refers_to"), "warc-index")


READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def parse(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of the record and of its HTTP head, and the payload."""

    def fields(lines: bytes) -> dict[str, str]:
        return dict(x.split(": ", 1) for x in lines.decode("utf-8").split("\r\n")[1:] if ": " in x)

    end = record.index(b"\r\n\r\n")
    said = fields(record[:end])
    block = record[end + 4 : end + 4 + int(said["Content-Length"])]
    if not record.startswith(b"WARC/1.0\r\n") or record[end + 4 + len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length doesn't fit the index")
    end = block.index(b"\r\n\r\n")
    return said, fields(block[:end]), block[end + 4 :]


def read_records(index: DataFrame, payloads: bool = True, gap: int = GAP, most: int = RANGE_BYTES) -> DataFrame:
    """Reads the records that ``index`` holds (all, or any selection of its rows), by archive and offset.

    Neighbouring records are read at once while the bytes between them are at most ``gap`` and the range at most ``most`` (or one record).
    Each record is parsed; of responses the payload's length and digest are computed from the bytes read and checked against the header.
    Revisits have no payload: null, with the length and digest of their header. Without ``payloads`` that column is null.
    Files are opened by their URI (any file system that pyarrow knows), never as local paths.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple = (None, None)
        for batch in batches:
            rows = batch.to_pylist()
            at = 0
            while at < len(rows):
                first = rows[at]
                to, end = at, first["offset"]
                while to < len(rows) and rows[to]["path"] == first["path"] and rows[to]["offset"] - end <= gap and (to == at or rows[to]["offset"] + rows[to]["length"] - first["offset"] <= most):
                    end = rows[to]["offset"] + rows[to]["length"]
                    to += 1
                if opened[0] != first["path"]:
                    uri = first["path"]
                    uri = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
                    system, path = pa.fs.FileSystem.from_uri(uri)
                    opened = (first["path"], system.open_input_file(path))
                data = opened[1].read_at(end - first["offset"], first["offset"])
                out = []
                for row in rows[at:to]:
                    start = row["offset"] - first["offset"]
                    said, http, payload = parse(data[start : start + row["length"]])
                    digest = said["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(http["Content-Length"])
                    if said["WARC-Type"] == "response":
                        size, found = len(payload), hashlib.sha1(payload).hexdigest()
                        if found != digest:
                            raise ValueError(f"payload digest {found} isn't the header's {digest}")
                    refers = said.get("WARC-Refers-To", "").removeprefix("<urn:sha1:").rpartition("-")[0]
                    out.append((row["page_id"], said["WARC-Target-URI"] if "WARC-Target-URI" in said else "", payload if payloads and said["WARC-Type"] == "response" else None, size, digest, said["WARC-Type"], int(refers) if refers else None))
                at = to
                kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    chosen = index.select("page_id", "path", "offset", "length").repartition("path").sortWithinPartitions("path", "offset")
    return chosen.mapInArrow(run, READ)
