"""Index of WARC archives that others wrote, found by reading them once, and reads of selected records by merged byte ranges.

A record's length stands in its head, so an archive is walked from its start: one task an archive, a chunk in memory at a time, payloads hashed as
they stream by. Compressed archives have a gzip member a record, and the index holds the member's place in the file.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

CHUNK, HEAD_BYTES = 1 << 20, 1 << 20
GAP, RANGE_BYTES = 64 << 10, 4 << 20
END = b"\r\n\r\n"
INDEX = "path string, offset long, length long, record_type string, record_id string, url string, payload_bytes long, payload_digest string"


class Stream:
    """Bytes that come in chunks: taken up to a separator or by number, never held but for what is asked for."""

    def __init__(self, chunks: Iterable[bytes]):
        self.chunks, self.held, self.at = iter(chunks), b"", 0

    def more(self) -> bool:
        chunk = next(self.chunks, b"")
        self.held += chunk
        return bool(chunk)

    def _take(self, n: int) -> bytes:
        out, self.held = self.held[:n], self.held[n:]
        self.at += len(out)
        return out

    def until(self, end: bytes, most: int = HEAD_BYTES) -> bytes:
        """Up to and with ``end``; ValueError if it isn't there or more than ``most`` bytes away."""
        while (found := self.held.find(end)) < 0:
            if len(self.held) > most or not self.more():
                raise ValueError(f"no end of a head at byte {self.at}")
        return self._take(found + len(end))

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes as they come; ValueError if there are fewer."""
        while n:
            if not self.held and not self.more():
                raise ValueError(f"the stream ends {n} bytes early at byte {self.at}")
            piece = self._take(n)
            n -= len(piece)
            yield piece

    def skip_breaks(self) -> bool:
        """Passes line ends; whether anything follows."""
        while self.held or self.more():
            kept = self.held.lstrip(b"\r\n")
            self.at += len(self.held) - len(kept)
            self.held = kept
            if kept:
                return True
        return False


def fields(head: bytes) -> dict[str, str]:
    """Named fields by lower-cased name; the first line is left out, folded lines are joined."""
    out: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def hex_digest(said: str) -> str | None:
    """A SHA-1 as it stands in a head, in base 32 or 16, as lower-case hex; None for others."""
    kind, _, value = said.partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()
    except ValueError:
        return None


def body_at(block: bytes) -> int:
    """Where the body of an HTTP block starts; 0 if no head ends within ``HEAD_BYTES``."""
    return block.find(END, 0, HEAD_BYTES) + len(END) if END in block[:HEAD_BYTES] else 0


def record(stream: Stream) -> tuple:
    """(record_type, record_id, url, payload_bytes, payload_digest) of the record that the stream is at, which is passed with its end.

    Of HTTP blocks the payload is what follows their head, of others, and of those in which no head ends within ``HEAD_BYTES``, the block. Revisits have the digest of their head and no bytes (0).
    """
    head = stream.until(END)
    if not head.startswith(b"WARC/"):
        raise ValueError(f"no record at byte {stream.at - len(head)}")
    said = fields(head[: -len(END)])
    if "content-length" not in said:
        raise ValueError(f"a record without a length before byte {stream.at}")
    left, kind = int(said["content-length"]), said.get("warc-type")
    http = said.get("content-type", "").lower().startswith("application/http")
    digest, size, opening = hashlib.sha1(), 0, b""
    for piece in stream.pieces(left):
        if http:  # still in the head of the block
            opening += piece
            end = body_at(opening)
            if not end and len(opening) < HEAD_BYTES:
                continue
            piece, opening, http = opening[end:], b"", False
        digest.update(piece)
        size += len(piece)
    digest.update(opening)
    size += len(opening)
    if b"".join(stream.pieces(len(END))) != END:
        raise ValueError(f"a record's length doesn't fit before byte {stream.at}")
    found = digest.hexdigest()
    if kind == "revisit":
        size, found = 0, hex_digest(said.get("warc-payload-digest", ""))
    url = said.get("warc-target-uri")
    return kind, said.get("warc-record-id"), url[1:-1] if url and url.startswith("<") and url.endswith(">") else url, size, found


def members(file, start: bytes, chunk: int) -> Iterator[tuple]:
    """(offset, length, record) of each gzip member; ``start``: bytes of the file that were read already."""
    state = {"raw": start, "at": 0}

    def unpacked() -> Iterator[bytes]:
        unzip = zlib.decompressobj(31)
        while not unzip.eof:
            raw = state["raw"] or file.read(chunk)
            out = unzip.decompress(raw, chunk)
            rest = unzip.unused_data if unzip.eof else unzip.unconsumed_tail
            if not raw and not out and not unzip.eof:
                raise ValueError(f"the archive ends within the member at byte {state['at']}")
            state.update(raw=rest, at=state["at"] + len(raw) - len(rest))
            if out:
                yield out

    while True:
        state["raw"] = state["raw"] or file.read(chunk)
        if not state["raw"]:
            return
        begin, stream = state["at"], Stream(unpacked())
        row = record(stream)
        if stream.skip_breaks():
            raise ValueError(f"the member at byte {begin} holds more than one record")
        yield begin, state["at"] - begin, row


def scan(file, chunk: int = CHUNK) -> Iterator[tuple]:
    """(offset, length, record) of each record of an open archive, compressed or not. ValueError where it isn't one or ends early."""
    start = file.read(max(chunk, 2))
    if start[:2] == b"\x1f\x8b":
        yield from members(file, start, chunk)
        return

    def chunks() -> Iterator[bytes]:
        piece = start
        while piece:
            yield piece
            piece = file.read(chunk)

    stream = Stream(chunks())
    while stream.skip_breaks():
        begin = stream.at
        row = record(stream)
        yield begin, stream.at - begin, row


def opened(uri: str):
    """The file of a URI, of any file system that pyarrow knows."""
    uri = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    system, path = pa.fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def index_archives(spark: SparkSession, folder: str, pattern: str = "*.warc*", chunk: int = CHUNK) -> DataFrame:
    """(path, offset, length, record_type, record_id, url, payload_bytes, payload_digest) of every record of the archives under ``folder``.

    Archives are listed with their lengths and read by the task that walks them. Digests are SHA-1 of payloads as stored, in lower-case hex.
    A folder without archives gives no rows, and so does an empty archive; one that is damaged raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in INDEX.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for paths in batches:
            for path in paths.column(0).to_pylist():
                rows: list[tuple] = []
                with opened(path) as file:
                    for offset, length, (kind, name, url, size, digest) in scan(file, chunk):
                        rows.append((path, offset, length, kind, name, url, size, digest))
                        if len(rows) == 4096:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path")
    return files.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "path").mapInArrow(run, INDEX)


def read_ranges(rows: list[dict], gap: int = GAP, most: int = RANGE_BYTES) -> Iterator[tuple[dict, bytes]]:
    """Rows (path, offset, length), sorted by these, with their bytes; neighbours at most ``gap`` apart are read at once, up to ``most`` bytes."""
    at, path, file = 0, None, None
    while at < len(rows):
        first, to = rows[at], at
        end = first["offset"]
        while to < len(rows) and rows[to]["path"] == first["path"] and rows[to]["offset"] - end <= gap and (to == at or rows[to]["offset"] + rows[to]["length"] - first["offset"] <= most):
            end = max(end, rows[to]["offset"] + rows[to]["length"])
            to += 1
        if path != first["path"]:
            path, file = first["path"], opened(first["path"])
        data = file.read_at(end - first["offset"], first["offset"])
        for row in rows[at:to]:
            yield row, data[row["offset"] - first["offset"] :][: row["length"]]
        at = to


def payload_of(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields of a whole record, compressed or not, and its payload."""
    data = zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data
    end = data.index(END)
    said = fields(data[:end])
    block = data[end + len(END) :][: int(said["content-length"])]
    http = said.get("content-type", "").lower().startswith("application/http")
    return said, block[body_at(block) :] if http else block


def read_payloads(index: DataFrame, gap: int = GAP, most: int = RANGE_BYTES) -> DataFrame:
    """(path, offset, record_type, url, payload) of the records in ``index`` (all, or any selection of its rows), checked against its digests.

    Revisits have null for a payload. ValueError where the bytes read don't have the digest of the index.
    """
    shape = "path string, offset long, record_type string, url string, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data in read_ranges(batch.to_pylist(), gap, most):
                _, payload = payload_of(data)
                if row["record_type"] == "revisit":
                    payload = None
                elif hashlib.sha1(payload).hexdigest() != row["payload_digest"]:
                    raise ValueError(f"{row['path']} at {row['offset']}: the payload isn't the index's")
                yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("path", "offset", "record_type", "url")} | {"payload": payload}], pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload", pa.binary())]))

    chosen = index.select("path", "offset", "length", "record_type", "url", "payload_digest").repartition("path").sortWithinPartitions("path", "offset")
    return chosen.mapInArrow(run, shape)
