"""Seekable WARC bundles: records in independent zstandard frames, with a seek table at the end.

A bundle is one binary value. Its frames can be read alone, as can the whole bundle by any
zstandard decoder: the seek table is a skippable frame in the seekable format. The index
maps a record to its frame and to its place in the frame's content.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import narrowed

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 32 << 20  # of content, before compression
LEVEL = 6

INDEX = (
    "array<struct<record_id: string, page_id: long, frame: int, place: long, length: long>>"
)


def classified(pages: DataFrame) -> DataFrame:
    """Per row: ``page_id``, ``url``, ``payload``, ``sha1``, ``copies``, ``first_id``,
    ``first_copies`` and ``is_first``.

    Payloads are equal if SHA-1 and MD5 both are. Of equal payloads the smallest ``page_id``
    is the first; NULL ids come last. ``copies`` counts the rows alike in id and payload. Only
    ids and digests are grouped; payloads move once, spread by page and digest.
    """
    rows = narrowed(pages, page_id="long", url="string", html="string").select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    digest = F.concat(F.sha1("payload"), F.md5("payload"))
    ids = rows.select("page_id", digest.alias("digest"))
    ids = ids.groupBy("page_id", "digest").agg(F.count("*").alias("copies"))
    first_copies = F.coalesce(F.min_by("copies", "page_id"), F.max("copies"))
    firsts = ids.groupBy("digest").agg(
        F.min("page_id").alias("first_id"), first_copies.alias("first_copies")
    )
    each = ids.join(firsts, "digest").withColumnRenamed("page_id", "known_id")
    rows = rows.withColumn("own", digest)
    same = F.col("page_id").eqNullSafe(F.col("known_id")) & (F.col("own") == F.col("digest"))
    first = F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(each, same).select(
        "page_id",
        "url",
        "payload",
        F.substring("digest", 1, 40).alias("sha1"),
        "copies",
        "first_id",
        "first_copies",
        first.alias("is_first"),
    )


def _record_id(page_id: int | None, sha1: str, place: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{sha1}{place}')}>"


def _record(row: dict, place: str) -> tuple[str, bytes]:
    """Id and bytes of the record of a row.

    The ids of rows alike in page and payload are told apart by the record's ``place``; no
    other record can name one of those then.
    """
    payload, sha1 = row["payload"], row["sha1"]
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    kind = "response" if row["is_first"] else "revisit"
    record_id = _record_id(row["page_id"], sha1, f":{place}" if row["copies"] > 1 else "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if row["is_first"] else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", "1970-01-01T00:00:00Z"),  # the tables know no time of capture
        ("WARC-Payload-Digest", digest),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", quote(row["url"], safe=":/?#[]@!$&'()*+,;=%-._~")))
    if row["page_id"] is not None:
        fields.append(("X-Page-ID", str(row["page_id"])))
    if kind == "revisit":
        fields += [
            (
                "WARC-Profile",
                "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            ),
            ("X-Refers-To-Page-ID", str(row["first_id"])),
        ]
        if row["first_copies"] == 1:
            fields.append(("WARC-Refers-To", _record_id(row["first_id"], sha1)))
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return record_id, head.encode() + block + b"\r\n\r\n"


class Bundle:
    """Collects records into frames."""

    def __init__(self, frame_bytes: int) -> None:
        self.name = uuid.uuid4().hex
        self.frame_bytes = frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[bytes] = []
        self.sizes: list[int] = []
        self.index: list[dict] = []
        self.open = bytearray()
        self.size = 0

    def add(self, record_id: str, page_id: int | None, record: bytes) -> None:
        self.index.append(
            {
                "record_id": record_id,
                "page_id": page_id,
                "frame": len(self.frames),
                "place": len(self.open),
                "length": len(record),
            }
        )
        self.open += record
        self.size += len(record)
        if len(self.open) >= self.frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            self.frames.append(self.compressor.compress(bytes(self.open)))
            self.sizes.append(len(self.open))
            self.open = bytearray()

    def content(self) -> bytes:
        self._close_frame()
        entries = b"".join(
            struct.pack("<II", len(frame), size)
            for frame, size in zip(self.frames, self.sizes, strict=True)
        )
        table = entries + struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from the end of a bundle."""
    count, descriptor, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table at the end")
    width = 12 if descriptor & 0x80 else 8  # with checksums
    start = len(bundle) - 9 - width * count
    out, offset = [], 0
    for i in range(count):
        packed, size = struct.unpack_from("<II", bundle, start + width * i)
        out.append((offset, packed, size))
        offset += packed
    return out


def read_frame(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    offset, packed, size = frame
    content = zstandard.ZstdDecompressor().decompress(bundle[offset : offset + packed], size)
    if len(content) != size:
        raise ValueError("a frame is not as long as the seek table says")
    return content


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a record: {version[:20]}")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


def records(content: bytes) -> Iterator[bytes]:
    """The records of a frame, by their lengths alone."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at) + 4
        field = content.rindex(b"\r\nContent-Length: ", at, end) + 18
        stop = end + int(content[field : end - 4]) + 4
        yield content[at:stop]
        at = stop


def write_bundles(
    pages: DataFrame, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Rows ``bundle``, ``content``, ``records``: archives of all pages, and their index.

    ``pages`` has ``page_id``, ``url`` and ``html``. A NULL html is an empty payload, a NULL
    url or id leaves its field out. Repeated rows are all written; those that carry the
    smallest id of their payload are all responses, each with a record id of its own. Other
    columns are ignored; no pages give no bundles. A bundle closes at ``bundle_bytes`` of content, or after one larger
    record, so a task holds one bundle at a time. Write the rows to a table before use:
    names of bundles are new in each run.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(bundle: Bundle) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "bundle": [bundle.name],
                    "content": pa.array([bundle.content()], pa.binary()),
                    "records": pa.array([bundle.index], index_type),
                }
            )

        bundle = Bundle(frame_bytes)
        for batch in batches:
            for i in range(batch.num_rows):
                fields = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                record_id, record = _record(fields, f"{bundle.name}:{len(bundle.index)}")
                bundle.add(record_id, fields["page_id"], record)
                if bundle.size >= bundle_bytes:
                    yield row(bundle)
                    bundle = Bundle(frame_bytes)
        if bundle.size:
            yield row(bundle)

    index_type = pa.list_(
        pa.struct(
            [
                ("record_id", pa.string()),
                ("page_id", pa.int64()),
                ("frame", pa.int32()),
                ("place", pa.int64()),
                ("length", pa.int64()),
            ]
        )
    )
    return classified(pages).mapInArrow(write, f"bundle string, content binary, records {INDEX}")


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, read frame by frame through the seek tables.

    The digest of a response is checked against its payload. Bundles without records and
    empty tables give no rows; a damaged bundle stops the job.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("content"):
                bundle = value.as_py()
                for frame in seek_table(bundle):
                    yield _rows(records(read_frame(bundle, frame)))

    return bundles.select("content").mapInArrow(
        read,
        "page_id long, record_id string, url string, payload binary, payload_bytes long, "
        "payload_digest string, record_type string, refers_to long",
    )


def _rows(found: Iterator[bytes]) -> pa.RecordBatch:
    out: dict[str, list] = {name: [] for name in READ.names}
    for record in found:
        fields, block = parse(record)
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        response = fields["WARC-Type"] == "response"
        if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
        page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
        out["page_id"].append(None if page is None else int(page))
        out["record_id"].append(fields["WARC-Record-ID"])
        out["url"].append(fields.get("WARC-Target-URI"))
        out["payload"].append(payload if response else None)
        out["payload_bytes"].append(size)
        out["payload_digest"].append(digest)
        out["record_type"].append(fields["WARC-Type"])
        out["refers_to"].append(None if refers is None else int(refers))
    return pa.RecordBatch.from_pydict(out, READ)


READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_id", pa.string()),
        ("url", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def read_record(bundle: bytes, frame: int, place: int, length: int) -> bytes:
    """One record of a bundle, by its entry in the index."""
    return read_frame(bundle, seek_table(bundle)[frame])[place : place + length]
