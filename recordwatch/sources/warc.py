"""Web archives (WARC 1.0) as a data source: what was fetched, with the status, address and type of every response.

``register`` makes the format ``warc`` known. A partition is a range of bytes of a file; a record belongs to the range that its
header begins in, so files are split without reading them first. Only responses are read, and a body is decoded only if the
schema asked for has ``html``: ``spark.read.format("warc").schema("url string, status int").load(folder)`` reads headers alone.
Paths are any that Arrow's file systems open and that all executors share. Writing gives a file for each task, which stands under
its name once all tasks are done.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "url string, status int, location string, content_type string, fetched_at timestamp, html string, file string, offset long"
RANGE_BYTES, BLOCK = 32 << 20, 1 << 20
START = b"WARC/1."
CHARSET = re.compile(r"charset=[\"']?([A-Za-z0-9_\-]+)", re.I)


def _open(path: str):
    """File system and path of an address that Arrow knows, or of a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int


def _fields(lines: list[bytes]) -> dict[str, str]:
    told = (line.partition(b":") for line in lines)
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in told}


class _Window:
    """Bytes of a file by place, read in blocks."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def get(self, place: int, n: int) -> bytes:
        if not (self.at <= place and place + n <= self.at + len(self.held)):
            self.file.seek(place)
            self.at, self.held = place, self.file.read(max(n, BLOCK))
        return self.held[place - self.at : place - self.at + n]

    def header(self, place: int) -> tuple[dict[str, str], int, int] | None:
        """Fields of the record header at a place, where its content begins and where the next record does; None if there is none."""
        n = 4096
        while True:
            got = self.get(place, n)
            head, end, _ = got.partition(b"\r\n\r\n")
            if end or len(got) < n:
                break
            n *= 4
        fields = _fields(head.split(b"\r\n")[1:]) if end and got.startswith(START) else {}
        if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
            return None
        body = place + len(head) + 4
        return fields, body, body + int(fields["content-length"]) + 4

    def first(self, place: int, end: int) -> int | None:
        """The first record that begins at ``place`` or after it and before ``end``: a header that another one, or the end of the file, follows."""
        while place < end:
            got = self.get(place, min(BLOCK, self.size - place))
            at = got.find(START)
            if at < 0:
                place += max(1, len(got) - len(START))
                continue
            place += at
            found = self.header(place)
            if place < end and found and (found[2] >= self.size or self.get(found[2], len(START)) == START):
                return place
            place += 1
        return None


def _response(content: bytes, wanted: set[str]) -> dict[str, object]:
    head, _, body = content.partition(b"\r\n\r\n")
    first, *rest = head.split(b"\r\n")
    status, fields = first.split(b" ")[1:2], _fields(rest)
    kind = fields.get("content-type")
    out: dict[str, object] = {"status": int(status[0]) if status and status[0].isdigit() else None, "location": fields.get("location"), "content_type": kind}
    if "html" in wanted:
        named = CHARSET.search(kind or "")
        try:
            out["html"] = body.decode(named[1] if named else "utf-8", "replace")
        except LookupError:
            out["html"] = body.decode("utf-8", "replace")
    return out


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.names, self.path = schema.fieldNames(), options["path"]
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[Range]:
        from pyarrow import fs

        system, path = _open(self.path)
        info = system.get_file_info(path)
        files = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        prefix = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        return [
            Range(prefix + f.path, at, min(at + self.range_bytes, f.size))
            for f in sorted(files, key=lambda f: f.path)
            if f.type == fs.FileType.File and f.path.endswith(".warc") and not f.base_name.startswith((".", "_"))
            for at in range(0, f.size, self.range_bytes)
        ]

    def read(self, partition: Range | None) -> Iterator[tuple]:
        if partition is None:  # no files at all
            return
        system, path = _open(partition.file)
        wanted = set(self.names)
        with system.open_input_file(path) as file:
            window = _Window(file, file.size())
            place = window.first(partition.start, partition.end)
            while place is not None and place < partition.end:
                found = window.header(place)
                if found is None:
                    place = window.first(place + 1, partition.end)
                    continue
                fields, body, after = found
                if fields["warc-type"] == "response":
                    size = after - 4 - body
                    content = window.get(body, size) if "html" in wanted else window.get(body, min(size, 1 << 16))
                    at = fields.get("warc-date", "").replace("Z", "+00:00")
                    row = _response(content, wanted) | {"url": fields.get("warc-target-uri", "").strip("<>"), "file": partition.file, "offset": place, "fetched_at": datetime.fromisoformat(at) if at else None}
                    yield tuple(row.get(name) for name in self.names)
                place = after


@dataclass
class Written(WriterCommitMessage):
    file: str
    n: int


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"].rstrip("/")

    def write(self, iterator: Iterator[Row]) -> Written:
        system, path = _open(self.path)
        system.create_dir(path, recursive=True)
        file, n = f"{path}/.{uuid.uuid4().hex}.warc", 0
        with system.open_output_stream(file) as out:
            for row in iterator:
                body = (row.html or "").encode()
                place = f"Location: {row.location}\r\n" if row.location else ""
                head = f"HTTP/1.1 {row.status} -\r\nContent-Type: {row.content_type or 'text/html; charset=utf-8'}\r\n{place}\r\n".encode()
                at = (row.fetched_at or datetime(1970, 1, 1)).astimezone(timezone.utc).isoformat().replace("+00:00", "Z")
                told = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {at}\r\nWARC-Target-URI: {row.url}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(head) + len(body)}\r\n\r\n"
                out.write(told.encode() + head + body + b"\r\n\r\n")
                n += 1
        return Written(file, n)

    def commit(self, messages: list[Written | None]) -> None:
        system, _ = _open(self.path)
        for m in messages:
            if m is not None:
                folder, name = m.file.rsplit("/", 1)
                system.move(m.file, f"{folder}/{name.removeprefix('.')}")

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = _open(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(m.file)


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Warc)
