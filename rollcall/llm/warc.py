"""WARC archives (ISO 28500) as a Spark data source: ``df.write.format("warc")`` and ``spark.read.format("warc")``, after ``register(spark)``.

Rows are records. Each record is a gzip member of its own. A writing task rolls its archive over at ``roll`` bytes, so a reading task never has more than about that much to do; readers stream
an archive record by record. The files of a write are named in the list that the commit leaves beside them, so what lost or repeated attempts leave behind is never read. A folder without a list (archives
made elsewhere) is read whole. Files are reached through Arrow's file systems, so the path may be a local or shared folder or a store that Arrow knows.

Columns of a record: record_id, type, date, target_uri, concurrent_to (array), refers_to, profile, digest (of the payload, as declared), content_type, http (start line and header fields up to the
empty line; null where the block is no HTTP message), payload (the block, or what follows the HTTP header), payload_bytes, sha1 (bare upper-case base32 of the payload found), archive. With the option ``payload`` = false
the bodies of HTTP messages are measured and left out. On writing, null fields are left out, lengths and block digests are made, and type, record_id and date must be given.

Malformed input is an error: a record that ends early, a missing length, or a header line without a colon.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

COLUMNS = (
    "record_id string, type string, date string, target_uri string, concurrent_to array<string>, refers_to string, profile string, digest string, content_type string, "
    "http string, payload binary, payload_bytes long, sha1 string, archive string"
)
#: Fixed values of the format: the version line, and the field of each column.
VERSION = "WARC/1.1"
FIELDS = {
    "type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "concurrent_to": "WARC-Concurrent-To",
    "refers_to": "WARC-Refers-To",
    "profile": "WARC-Profile",
    "digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
}
IN_BRACKETS = {"record_id", "concurrent_to", "refers_to", "profile"}
LIST = "_archives.json"
#: Bytes of an archive at which the next one begins, and rows or bytes that a reader hands to Spark at once.
ROLL, ROWS, BATCH = 256 << 20, 2000, 8 << 20
LEVEL = 4


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def uri_text(url: str) -> str:
    """A URL as a header field can hold it: control characters and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(row: dict) -> bytes:
    """One record of a row with the columns of :data:`COLUMNS`."""
    payload = row["payload"] or b""
    block = payload if row["http"] is None else row["http"].encode() + b"\r\n\r\n" + payload
    lines = [VERSION]
    for column, field in FIELDS.items():
        values = row[column] if column == "concurrent_to" else [row[column]]
        for value in values or []:
            if value is not None:
                lines.append(f"{field}: <{value}>" if column in IN_BRACKETS else f"{field}: {value}")
    lines += [f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class Members:
    """Bytes of all gzip members of a file one after another (or of a plain file), read in pieces."""

    def __init__(self, source) -> None:
        self.source, self.held, self.out = source, source.read(2), b""
        self.zipped = self.held == b"\x1f\x8b"
        self.member = zlib.decompressobj(31) if self.zipped else None

    def more(self) -> bool:
        data = self.held or self.source.read(1 << 20)
        self.held = b""
        if not data:
            if self.member is not None and not self.member.eof:
                raise ValueError("an archive ends within a record")
            return False
        if not self.zipped:
            self.out += data
            return True
        if self.member.eof:
            self.member = zlib.decompressobj(31)
        self.out += self.member.decompress(data)
        self.held = self.member.unused_data
        if self.member.eof and not self.held:
            self.held = self.source.read(1 << 20)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.out.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.out)
            if not self.more():
                if self.out.strip(b"\r\n"):
                    raise ValueError("an archive ends within a record")
                return None
        found, self.out = self.out[:at], self.out[at + len(mark) :]
        return found

    def take(self, count: int) -> bytes:
        parts, have = [self.out], len(self.out)
        while have < count:
            self.out = b""
            if not self.more():
                raise ValueError("an archive ends within a record")
            parts.append(self.out)
            have += len(self.out)
        data = b"".join(parts)
        self.out = data[count:]
        return data[:count]


def fields_of(header: bytes) -> list[tuple[str, str]]:
    """Names in lower case and values of a record's header; folded lines are joined."""
    out: list[tuple[str, str]] = []
    for line in re.sub(r"\r\n[ \t]+", " ", header.decode("utf-8", "replace")).split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"no colon in a header line: {line[:80]!r}")
        out.append((name.strip().lower(), value.strip()))
    return out


def records(source, archive: str, keep_payload: bool) -> Iterator[dict]:
    """The records of an open archive."""
    members = Members(source)
    named = {field.lower(): column for column, field in FIELDS.items()}
    while (header := members.until(b"\r\n\r\n")) is not None:
        header = header.lstrip(b"\r\n")
        if not header:
            continue
        row: dict = dict.fromkeys([*FIELDS, "http"])
        row["concurrent_to"], length = [], None
        for name, value in fields_of(header):
            if name == "content-length":
                length = int(value)
            if (column := named.get(name)) is None:
                continue
            value = value.removeprefix("<").removesuffix(">") if column in IN_BRACKETS else value
            if column == "concurrent_to":
                row[column].append(value)
            else:
                row[column] = value
        if length is None:
            raise ValueError("a record without a length")
        block = members.take(length)
        body = (row["content_type"] or "").startswith("application/http")
        if body:
            http, gap, payload = block.partition(b"\r\n\r\n")
            row["http"], block = http.decode("utf-8", "replace"), payload if gap else b""
        row |= {"payload": block if keep_payload or not body else None, "payload_bytes": len(block), "sha1": sha1_base32(block), "archive": archive}
        yield row


def arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "array<string>": pa.list_(pa.string()), "binary": pa.binary(), "long": pa.int64()}
    return pa.schema([pa.field(name, kinds[kind]) for name, kind in (c.split() for c in COLUMNS.split(", "))])


@dataclass
class Archive(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class Reader(DataSourceReader):
    def __init__(self, path: str, keep_payload: bool) -> None:
        self.path, self.keep_payload = path, keep_payload

    def partitions(self) -> list[Archive]:
        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        files = {i.path: i.size for i in found if i.is_file}
        lists = [p for p in files if p.endswith("/" + LIST)]
        if lists:
            names = [f"{p.rpartition('/')[0]}/{n}" for p in lists for n in json.loads(store.open_input_stream(p).readall())]
        else:
            names = [p for p in files if re.search(r"\.warc(\.gz)?$", p)]
        return [Archive(n) for n in sorted(names, key=lambda n: -files[n])]

    def read(self, partition: Archive | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archives
            return
        schema = arrow_schema()
        store, _ = fs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        with store.open_input_file(partition.path) as source:
            for row in records(source, partition.path.rpartition("/")[2], self.keep_payload):
                rows.append(row)
                held += len(row["payload"] or b"")
                if len(rows) >= ROWS or held >= BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, roll: int) -> None:
        self.path, self.roll = path, roll

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        names: list[str] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                    zipper = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    data = zipper.compress(record(row)) + zipper.flush()
                    out.write(data)
                    size += len(data)
                    if size >= self.roll:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        if store.get_file_info(f"{root}/{LIST}").is_file:
            raise FileExistsError(f"{self.path} already holds archives")
        with store.open_output_stream(f"{root}/{LIST}") as out:
            out.write(json.dumps(sorted(n for m in messages if m for n in m.names)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        for name in (n for m in messages if m for n in m.names):
            store.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    """Options: path; payload (false: only measure the bodies of HTTP messages); roll (bytes of an archive)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], int(self.options.get("roll", ROLL)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)


def parsed(data: bytes, keep_payload: bool = True) -> list[dict]:
    """The records of an archive in memory, for small inputs and tests."""
    return list(records(io.BytesIO(data), "", keep_payload))
