"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with some whole records, and a skippable frame at
its end with the seek table of the public seekable format: compressed and plain size of every frame. The
index maps each record's identifier to its bundle, frame and offset inside the plain frame, so one record
is read by decoding one frame. Tools that know only plain Zstandard read a bundle from start to end.

Bundles are written by the tasks into the shared folder, under names of their own for each attempt. The
index is written by Spark and names the files of the attempts that succeeded, so a lost executor leaves at
most a file that nothing refers to.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEAST_REVISIT_BYTES = 1000
LEVEL = 3

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
FOOTER_BYTES = 9

# Fixed values of WARC.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = ("record_id string, page_id bigint, bundle string, frame int, frame_offset bigint, "
                "frame_bytes bigint, record_offset bigint, record_bytes bigint")
RECORD_SCHEMA = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
                 "refers_to bigint, payload binary")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(identifier: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", identifier or "")
    return int(found[1]) if found else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool, date: str) -> bytes:
    """One WARC record. A revisit holds the HTTP header only, whose length field is that of the full payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode()
    head = [f"WARC/1.1\r\nWARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(plain: memoryview, offset: int) -> tuple[dict[str, str], bytes, int]:
    """(header fields, block, offset behind the record) of the record at ``offset``."""
    window = 1024
    while True:
        text = bytes(plain[offset:offset + window])
        stop = text.find(b"\r\n\r\n")
        if stop >= 0:
            break
        if offset + window >= len(plain):
            raise ValueError("a record's header does not end")
        window *= 4
    lines = text[:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    start = offset + stop + 4
    end = start + int(fields["Content-Length"])
    return fields, bytes(plain[start:end]), end + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame at a bundle's end for frames of these (compressed, plain) sizes."""
    entries = b"".join(struct.pack("<II", *frame) for frame in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of a bundle's frames, from its end."""
    size = file.size()
    file.seek(size - FOOTER_BYTES)
    count, flags, magic = struct.unpack("<IBI", file.read(FOOTER_BYTES))
    if magic != SEEK_MAGIC or flags:
        raise ValueError("the file has no seek table")
    file.seek(size - FOOTER_BYTES - 8 * count)
    sizes = struct.unpack(f"<{2 * count}I", file.read(8 * count))
    out, offset = [], 0
    for compressed, plain in zip(sizes[::2], sizes[1::2]):
        out.append((offset, compressed, plain))
        offset += compressed
    return out


class _Bundle:
    """An open bundle: frames go to the file as they fill up, so a task holds one frame in memory."""

    def __init__(self, system: pafs.FileSystem, folder: str, frame_bytes: int) -> None:
        self.frame_bytes = frame_bytes
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.file = system.open_output_stream(f"{folder}/{self.name}", compression=None)
        self.frames: list[tuple[int, int]] = []
        self.size = 0
        self.plain = bytearray()
        self.waiting: list[tuple[str, int | None, int, int]] = []

    def add(self, page_id: int | None, record: bytes) -> list[tuple]:
        self.waiting.append((record_id(page_id), page_id, len(self.plain), len(record)))
        self.plain += record
        return self.end_frame() if len(self.plain) >= self.frame_bytes else []

    def end_frame(self) -> list[tuple]:
        """Writes the frame; index rows of its records."""
        if not self.waiting:
            return []
        packed = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(bytes(self.plain))
        rows = [(rid, page, self.name, len(self.frames), self.size, len(packed), offset, length)
                for rid, page, offset, length in self.waiting]
        self.file.write(packed)
        self.frames.append((len(packed), len(self.plain)))
        self.size += len(packed)
        self.plain.clear()
        self.waiting.clear()
        return rows

    def close(self) -> list[tuple]:
        rows = self.end_frame()
        self.file.write(seek_table(self.frames))
        self.file.close()
        return rows


def with_record_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is the largest page_id with an equal payload of at least
    LEAST_REVISIT_BYTES, null where the page is that one or has no equal.

    Payloads count as equal by their SHA-256. A null payload is empty; pages without an id are responses;
    rows that repeat the largest id are all responses.
    """
    source = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    keyed = source.withColumn("payload_key", F.when(
        F.octet_length("html") >= LEAST_REVISIT_BYTES, F.unhex(F.sha2("html", 256))))
    last = (keyed.where("payload_key IS NOT NULL").groupBy("payload_key")
            .agg(F.max("page_id").alias("last"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    # Small pages go round the join, where their null keys would meet in one task.
    joined = keyed.where("payload_key IS NOT NULL").join(last, "payload_key", "left").select(
        "page_id", "url", "html", F.when(F.col("page_id") < F.col("last"), F.col("last")).alias("refers_to"))
    small = keyed.where("payload_key IS NULL").select(
        "page_id", "url", "html", F.lit(None).cast("bigint").alias("refers_to"))
    return joined.unionByName(small)


def write_bundles(pages: DataFrame, folder: str, date: str = "2020-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes ``pages`` as bundles below ``folder`` and returns the index, read back from ``folder``/index.

    ``folder`` is a URI or path that all executors share. An empty table gives an empty index. Pages of one id, and those
    without an id, share a record identifier; the index has a row for each of them, and a lookup returns them all.
    """
    bundles = f"{folder}/bundles"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _system(bundles)
        system.create_dir(path, recursive=True)
        names = [part.split()[0] for part in INDEX_SCHEMA.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32()] + [pa.int64()] * 4

        def index(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)

        bundle = None
        for batch in batches:
            for k in range(batch.num_rows):
                page_id, url, html, refers_to = (batch.column(c)[k].as_py() for c in range(4))
                payload = html.encode()
                bundle = bundle or _Bundle(system, path, frame_bytes)
                rows = bundle.add(page_id, record_bytes(
                    page_id, url, payload, hashlib.sha1(payload).hexdigest(), refers_to, refers_to is not None, date))
                if rows:
                    yield index(rows)
                if bundle.size >= bundle_bytes:
                    if rows := bundle.close():
                        yield index(rows)
                    bundle = None
        if bundle and (rows := bundle.close()):
            yield index(rows)

    spark = pages.sparkSession
    with_record_types(pages).mapInArrow(write, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def _decoded(system: pafs.FileSystem, path: str, offset: int, size: int) -> memoryview:
    with system.open_input_file(path) as file:
        file.seek(offset)
        return memoryview(zstandard.ZstdDecompressor().decompress(file.read(size)))


def _row(fields: dict[str, str], block: bytes) -> tuple:
    """A record as a row; a response's payload is checked against its digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: ([0-9]+)", head)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    return (_page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), length, digest, fields["WARC-Type"],
            _page_of(fields.get("WARC-Refers-To")), None if revisit else payload)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)


def _system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        pafs.LocalFileSystem(), folder)


def read_bundles(spark: SparkSession, index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of the bundles that ``index`` names, frame by frame along each bundle's seek table."""
    bundles = f"{folder}/bundles"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _system(bundles)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{path}/{name}") as file:
                    table = read_seek_table(file)
                for offset, size, plain_size in table:
                    plain = _decoded(system, f"{path}/{name}", offset, size)
                    if len(plain) != plain_size:
                        raise ValueError(f"a frame of {name} does not have its size")
                    at, rows = 0, []
                    while at < len(plain):
                        fields, block, at = parse_record(plain, at)
                        row = _row(fields, block)
                        rows.append(row if payloads else (*row[:-1], None))
                    yield _batch(rows)

    # One bundle is a task's work; a stated number of partitions is not merged for the names' small size.
    names = index.select("bundle").distinct().repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "bundle")
    return names.mapInArrow(read, RECORD_SCHEMA)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given index rows only: one frame is read and decoded for each run of rows in it."""
    bundles = f"{folder}/bundles"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _system(bundles)
        last, plain = None, memoryview(b"")
        for batch in batches:
            rows = []
            for name, offset, size, at in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if last != (name, offset):
                    last, plain = (name, offset), _decoded(system, f"{path}/{name}", offset, size)
                fields, block, _ = parse_record(plain, at)
                rows.append(_row(fields, block))
            if rows:
                yield _batch(rows)

    return (index.select("bundle", "frame_offset", "frame_bytes", "record_offset")
            .sortWithinPartitions("bundle", "frame_offset", "record_offset").mapInArrow(read, RECORD_SCHEMA))
