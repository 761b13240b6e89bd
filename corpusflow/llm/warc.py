"""WARC archives as seekable Zstandard bundles, written and read by tasks.

A bundle is a row of independent Zstandard frames, each with some whole WARC records, and ends in the
seek table of the seekable format (a skippable frame that plain decoders pass over). The index maps a
record to its bundle, its frame and its place within the frame's content, so one record costs one
frame. The index names only bundles of tasks that ended well: what a lost attempt wrote is never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.slices import bound_batches
from corpusflow.session import stage, work_path

# Bytes of records in a frame, and bytes of records after which a task begins its next bundle.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 1 << 30
# Bytes of records that a task reads: the least, and the most where there are more than two tasks a core.
READ_BYTES, READ_MOST = 4 << 20, 128 << 20
# Rows of the table of repeated payloads up to which it is broadcast (about 60 bytes a row).
BROADCAST_ROWS = 1_000_000
# Fixed values of the formats.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX = "record_id long, bundle string, frame int, offset long, length long"
RECORDS = "record_id long, record_type string, refers_to long, url string, payload_digest string, payload_bytes long, payload binary"


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(record_id: int | None) -> str:
    return f"<urn:page:{'' if record_id is None else record_id}>"


def _id(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def format_record(record_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the response it repeats."""
    revisit = refers_to is not None
    block = b"" if revisit else HTTP_HEAD + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(record_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("X-Payload-Length", str(len(payload)))]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of ``RECORDS`` from one record; a response's payload is held against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if version != "WARC/1.1":
        raise ValueError(f"not a WARC record: {version!r}")
    block = rest[: int(fields["Content-Length"])]
    revisit = fields["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and digest(payload) != named:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    return {
        "record_id": _id(fields["WARC-Record-ID"]),
        "record_type": fields["WARC-Type"],
        "refers_to": _id(fields.get("WARC-Refers-To")),
        "url": fields.get("WARC-Target-URI"),
        "payload_digest": named,
        "payload_bytes": int(fields["X-Payload-Length"]) if revisit else len(payload),
        "payload": payload,
    }


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame: packed and plain size of each frame, then the footer."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """(begin, packed size, plain size) of each frame of an open bundle."""
    end = source.size()
    count, flags, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("not a seekable bundle")
    entries = source.read_at(8 * count, end - 9 - 8 * count)
    frames, begin = [], 0
    for packed, plain in struct.iter_unpack("<II", entries):
        frames.append((begin, packed, plain))
        begin += packed
    return frames


class _Bundle:
    """A bundle being written."""

    def __init__(self, folder: str):
        from pyarrow import fs
        from zstandard import ZstdCompressor

        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self._pack = ZstdCompressor(level=3, write_content_size=True).compress
        system, name = fs.FileSystem.from_uri(self.path)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        self._out = system.open_output_stream(name, compression=None)
        self._records: list[bytes] = []
        self._frames: list[tuple[int, int]] = []
        self._held = self.size = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        place = (len(self._frames), self._held, len(record))
        self._records.append(record)
        self._held += len(record)
        self.size += len(record)
        if self._held >= FRAME_BYTES:
            self._flush()
        return place

    def _flush(self) -> None:
        if self._records:
            packed = self._pack(b"".join(self._records))
            self._out.write(packed)
            self._frames.append((len(packed), self._held))
            self._records, self._held = [], 0

    def close(self) -> None:
        self._flush()
        self._out.write(seek_table(self._frames))
        self._out.close()


def write_archives(df: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write rows (``record_id long, url string, payload binary, refers_to long``) below ``folder``; return the index.

    ``folder`` is a place that all executors reach. Each task writes its own bundles, one frame in
    memory at a time. The index is written to the shared work folder at once, so the archives are
    written once. NULL payloads are written as empty, NULL ids and urls stay NULL; an empty table
    gives no bundle.
    """
    schema = pa.schema([("record_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, places = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle is None:
                    bundle = _Bundle(folder)
                record_id, url, payload, refers_to = row
                frame, offset, length = bundle.add(format_record(record_id, url, payload or b"", refers_to, date))
                places.append((record_id, bundle.path, frame, offset, length))
                if bundle.size >= BUNDLE_BYTES:
                    bundle.close()
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*places), schema)], schema=schema)
                    bundle, places = None, []
        if bundle is not None:
            bundle.close()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*places), schema)], schema=schema)

    bound_batches(df.sparkSession)
    rows = df.select("record_id", "url", F.col("payload").cast("binary"), "refers_to")
    return stage(rows.mapInArrow(write, INDEX), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """The records (``RECORDS``) that the rows of an index name; ``payload`` is NULL for revisits.

    Rows of one frame come together, so a frame is read and unpacked once. The number of tasks
    follows the bytes of the records, not the size of the index.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from zstandard import ZstdDecompressor

        unpack = lambda data: ZstdDecompressor().decompressobj().decompress(data)
        path = frame = source = content = None
        frames: list[tuple[int, int, int]] = []
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            found, held = [], 0
            for bundle, number, offset, length in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length"))):
                if bundle != path:
                    if source is not None:
                        source.close()
                    system, name = fs.FileSystem.from_uri(bundle)
                    source = system.open_input_file(name)
                    path, frame, frames = bundle, None, read_seek_table(source)
                if number != frame:
                    begin, packed, plain = frames[number]
                    content, frame = unpack(source.read_at(packed, begin)), number
                    if len(content) != plain:
                        raise ValueError(f"{bundle}: frame {number} has {len(content)} bytes, not {plain}")
                found.append(parse_record(content[offset : offset + length]))
                held += length
                if held >= FRAME_BYTES * 32:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], t) for n, t in zip(names, types)], names=names)
                    found, held = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], t) for n, t in zip(names, types)], names=names)

        if source is not None:
            source.close()

    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-size // READ_MOST), min(-(-size // READ_BYTES), 2 * index.sparkSession.sparkContext.defaultParallelism), 1)
    near = index.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return near.mapInArrow(read, RECORDS)


def refer_to_first(df: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``df`` (``record_id``, ``payload``, ...) with ``refers_to``: the least id of the rows of equal payload.

    NULL for that row itself, for payloads that nobody repeats, and for those under ``min_bytes``. NULL
    payloads count as empty. Rows without an id refer to the least id, or to nothing if all lack one.
    """
    keyed = df.drop("refers_to").withColumn("_digest", F.sha1(F.coalesce("payload", F.lit(b""))))
    large = F.octet_length(F.coalesce("payload", F.lit(b""))) >= min_bytes
    groups = keyed.where(large).groupBy("_digest").agg(F.min("record_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = stage(groups.where("_n > 1 and _first is not null").select("_digest", "_first"), "warc-payloads")
    # Read back from a table, a side too large to broadcast is shuffled, and hot digests are split.
    groups = F.broadcast(groups) if groups.count() <= BROADCAST_ROWS else groups
    other = large & ~F.col("record_id").eqNullSafe(F.col("_first"))
    return keyed.join(groups, "_digest", "left").withColumn("refers_to", F.when(other, F.col("_first"))).drop("_digest", "_first")


def archive_pages(df: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write a record per page below the shared work folder; the index of the archives."""
    c = lambda name: F.col(f"`{name}`")
    rows = df.select(c(page).cast("long").alias("record_id"), c(url).alias("url"), c(html).cast("binary").alias("payload"))
    return write_archives(refer_to_first(rows, min_bytes), work_path(df.sparkSession, "warc"))
