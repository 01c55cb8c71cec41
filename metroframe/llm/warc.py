"""WARC records in seekable Zstandard bundles.

A task writes its records into bundles: records are grouped into independent
Zstandard frames, and a seek table in a skippable frame at the end (the
public seekable format) gives every frame's compressed and plain size. An
index maps each record identifier to its bundle, frame and offset in the
plain frame, so one record is read by decompressing one frame.

Of the records of one payload only one holds it (response); the others are
revisit records that name it. Which one that is is decided by grouping the
payload digests; payloads move once at most, when rows meet that decision.

A bundle is written under a name of its own attempt and reaches the index
only with the rows of the attempt that succeeds, so lost or repeated tasks
leave unused files at worst, never wrong records.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyspark
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.llm.common import named, sliced, stored
from metroframe.session import work_path

#: public constants of the seekable format
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
LEAST_REVISIT = 1000
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 64 << 20, 3
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n"


def record_id(page_id: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def header_text(value: str) -> str:
    """``value`` on one line: other characters than visible ones are percent-encoded."""
    return "".join(c if " " < c < "\x7f" or c > "\xa0" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def make_record(page_id: object, uri: str | None, payload: bytes, digest: str, refers_to: object, date: str) -> tuple[str, bytes]:
    """(identifier, bytes) of one record. Without ``refers_to`` it is a
    response that holds the payload, else a revisit that names its response."""
    name = record_id(page_id, digest)
    body = payload if refers_to is None else b""
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name), ("WARC-Date", date),
              ("WARC-Target-URI", header_text(uri or "")), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    head = b"WARC/1.1" + END + b"".join(f"{k}: {v}".encode() + END for k, v in fields) + END
    return name, head + body + END + END


def parse_record(plain: bytes, at: int) -> tuple[dict[str, str], bytes]:
    """Header fields and body of the record at this offset."""
    end = plain.index(END + END, at)
    first, *lines = plain[at:end].split(END)
    if first != b"WARC/1.1":
        raise ValueError(f"no record at offset {at}")
    fields = dict(line.decode().split(": ", 1) for line in (x if b": " in x else x + b" " for x in lines))
    start = end + 4
    return fields, plain[start:start + int(fields["Content-Length"])]


class BundleWriter:
    """One bundle: frames, then the seek table."""

    def __init__(self, out, frame_bytes: int, level: int) -> None:
        self.out, self.most, self.codec = out, frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int]] = []
        self.plain: list[bytes] = []
        self.size = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in the plain frame). A record never crosses frames."""
        if self.plain and self.size + len(record) > self.most:
            self.flush()
        place = len(self.frames), self.size
        self.plain.append(record)
        self.size += len(record)
        return place

    def flush(self) -> None:
        if self.plain:
            packed = self.codec.compress(b"".join(self.plain))
            self.out.write(packed)
            self.written += len(packed)
            self.frames.append((len(packed), self.size))
            self.plain, self.size = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    """Reads single frames of a bundle through its seek table."""

    def __init__(self, file) -> None:
        self.file, size = file, file.size()
        file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE_MAGIC or flags:
            raise ValueError("no seek table")
        file.seek(size - 9 - 8 * count)
        packed = struct.unpack(f"<{2 * count}I", file.read(8 * count))
        self.sizes = list(zip(packed[::2], packed[1::2]))
        self.starts = [0]
        for n, _ in self.sizes:
            self.starts.append(self.starts[-1] + n)

    def frame(self, number: int) -> bytes:
        self.file.seek(self.starts[number])
        packed, plain = self.sizes[number]
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def decided(df: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null: response) per row."""
    rows = df.select(named(id_col).alias("page_id"), named(url_col).alias("url"), F.coalesce(named(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull())
    holders = large.groupBy("digest").agg(F.max("page_id").alias("holder"), F.min("page_id").alias("least_id")).where("holder <> least_id")
    # identifiers and digests only: a hot payload's copies are two written tables' rows, which can be split
    copies = stored(large.select("page_id", "digest"), "payload-digests")
    revisits = copies.join(stored(holders.select("digest", "holder"), "payload-holders"), "digest").where("page_id <> holder")
    revisits = stored(revisits.distinct().select(F.col("page_id").alias("id"), F.col("digest").alias("same"), "holder"), "revisits")
    return rows.join(revisits, F.expr("page_id = id and digest = same"), "left").select("page_id", "url", "payload", "digest", F.col("holder").alias("refers_to"))


def write_bundles(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  least_revisit: int = LEAST_REVISIT, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> DataFrame:
    """Write a record per row and return the index: record_id, bundle, frame,
    offset, length.

    Of the rows of one payload of at least ``least_revisit`` bytes that with
    the largest id is the response and the others revisit it; rows that share
    that largest id are all responses, as are rows without an id and smaller
    payloads. Null payloads are empty ones, null URLs empty; an empty table
    writes nothing. Records of equal rows share an identifier. Other columns
    are not read."""
    rows = decided(df, id_col, url_col, payload_col, least_revisit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        writer, rows_of = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            writer.close()
            columns = list(zip(*rows_of))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                                             ["record_id", "bundle", "frame", "offset", "length"])

        for batch in sliced(batches, "payload"):
            for page, url, payload, digest, other in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                if writer is None:
                    name = f"part-{pyspark.TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.zst"
                    writer, rows_of = BundleWriter(fs.open_output_stream(f"{root}/{name}", compression=None), frame_bytes, LEVEL), []
                identifier, record = make_record(page, url, payload, digest, other, date)
                frame, offset = writer.add(record)
                rows_of.append((identifier, name, frame, offset, len(record)))
                if writer.written >= bundle_bytes:
                    yield from finish()
                    writer = None
        if writer is not None:
            yield from finish()

    return stored(rows.mapInArrow(run, "record_id string, bundle string, frame int, offset long, length long"), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` lists, a row each: record_id, page_id (as
    text), uri, record_type, payload_bytes, payload_digest, refers_to (page, as
    text), payload (null for a revisit). Each frame is read once, by seek; a
    payload that does not have its digest is an error."""
    schema = ("record_id string, page_id string, uri string, record_type string, payload_bytes long, payload_digest string, "
              "refers_to string, payload binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        name, frame, reader, plain = None, None, None, b""
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for identifier, bundle, number, at in zip(*(batch.column(c).to_pylist() for c in ("record_id", "bundle", "frame", "offset"))):
                if bundle != name:
                    if reader is not None:
                        reader.file.close()
                    name, frame, reader = bundle, None, BundleReader(fs.open_input_file(f"{root}/{bundle}"))
                if number != frame:
                    frame, plain = number, reader.frame(number)
                fields, body = parse_record(plain, at)
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Record-ID"] != identifier or kind == "response" and hashlib.sha1(body).hexdigest() != digest:
                    raise ValueError(f"record {identifier} in {bundle} is damaged")
                size = len(body) if kind == "response" else int(fields["X-Payload-Length"])
                out.append((identifier, fields.get("X-Page-ID"), fields["WARC-Target-URI"], kind, size, digest,
                            fields.get("X-Refers-To-Page-ID"), body if kind == "response" else None))
                held += len(body)
                if held >= 4 << 20:
                    yield as_batch(out)
                    out, held = [], 0
            if out:
                yield as_batch(out)
        if reader is not None:
            reader.file.close()

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 2 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in schema.split(", ")])

    # the records of a frame go to one task, in order
    ordered = index.repartition("bundle", F.floor(F.col("frame") / 4)).sortWithinPartitions("bundle", "frame", "offset")
    return ordered.mapInArrow(run, schema)


def new_folder(df: DataFrame) -> str:
    """A folder of its own for bundles, in the cluster's shared one."""
    return work_path(df.sparkSession, "warc")
