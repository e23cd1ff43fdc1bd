"""Crawl archives as a Spark data source: plain ones split by byte ranges, gzip ones by members.

A range owns the records whose version line begins in it and reads past its end for the
last of them. A record whose declared length runs over a separator in its payload is
completed by a seek to its declared end, if a record or the file ends there; any other
length is false and the record ends at the separator. Nothing is held but one record
and one read buffer.

In a plain file the pieces inside such a completed record look like records too, perhaps in
another range. All are given out with their byte offsets, and ``outer_records`` takes the inner
ones away by offsets alone. A gzip member is parsed in order, so it has none; ranges find
members by their magic bytes and believe those that unfold to a version line. A member
may hold many records and is unfolded as a stream.

Files are opened with ``pyarrow.fs``, so every executor must reach the path's store from Python;
``reachable`` tells whether this host does.
"""

from __future__ import annotations

import fnmatch
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CRLF = b"\r\n"
EMPTY_LINE = CRLF * 2
#: Bytes of blank lines that may follow a record's declared end.
SLACK = 2 * len(EMPTY_LINE)
RANGE_BYTES = 64 << 20
READ_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
#: A row cannot be larger.
MOST = (1 << 31) - 1
SCHEMA = "file string, start bigint, stop bigint, raw binary"
_LENGTH = re.compile(rb"(?im)^Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r?$")
_TYPE = re.compile(rb"(?im)^WARC-Type:[ \t]*[^ \t\r\n]")


def _open_store(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"^file:/(?!//)", path):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def reachable(path: str) -> bool:
    """Whether Python can open the path's store and finds the path there."""
    try:
        store, place = _open_store(path)
        return store.get_file_info(place).type != fs.FileType.NotFound
    except (OSError, ValueError, pa.ArrowException):
        return False


def declared_end(piece: bytes) -> int | None:
    """Where a record's declared payload ends, from its head's start; null without a type or length."""
    head = piece.find(EMPTY_LINE)
    head = len(piece) if head < 0 else head
    length = _LENGTH.search(piece, 0, head) if _TYPE.search(piece, 0, head) else None
    return head + len(EMPTY_LINE) + int(length.group(1)) if length else None


def _without_end(piece: bytes, declared: int | None) -> bytes:
    """The last piece of a file without the empty line that ends it, unless that is part of what it declares."""
    if piece.endswith(EMPTY_LINE) and (declared is None or declared > len(piece)):
        return piece[: -len(EMPTY_LINE)]
    return piece


class ByteWindow:
    """Bytes of a file from ``base`` on, read as they are asked for and dropped as they are passed."""

    def __init__(self, file: pa.NativeFile, base: int, size: int):
        self.file, self.base, self.size, self.data = file, base, size, bytearray()

    def fill(self) -> bool:
        """Reads on; false at the file's end."""
        at = self.base + len(self.data)
        if at >= self.size:
            return False
        self.data += self.file.read_at(min(READ_BYTES, self.size - at), at)
        return True

    def find(self, wanted: bytes, at: int) -> int:
        """The first place of ``wanted`` from ``at`` on, or the file's size."""
        while True:
            found = self.data.find(wanted, at - self.base)
            if found >= 0:
                return self.base + found
            at = max(at, self.base + len(self.data) - len(wanted) + 1)
            if not self.fill():
                return self.size

    def take(self, start: int, stop: int) -> bytes:
        while self.base + len(self.data) < stop and self.fill():
            pass
        return bytes(self.data[start - self.base : stop - self.base])

    def drop(self, upto: int) -> None:
        del self.data[: max(0, upto - self.base)]
        self.base = max(self.base, upto)


def plain_records(file: pa.NativeFile, start: int, end: int, version: bytes) -> Iterator[tuple[int, int | None, bytes]]:
    """``(start, stop, raw)`` of the records that begin in ``[start, end)``; ``stop`` where one was completed."""
    size, line = file.size(), version + CRLF
    separator = EMPTY_LINE + line
    window = ByteWindow(file, max(0, start - len(EMPTY_LINE)), size)
    if start == 0 and window.take(0, len(line)) == line:
        at = 0
    else:
        at = window.find(separator, window.base) + len(EMPTY_LINE)
    while at < min(end, size):
        head = at + len(line)
        window.drop(at)
        following = window.find(separator, head)
        raw, stop = window.take(head, following), None
        declared = declared_end(raw)
        if declared is not None and head + declared > following and declared <= MOST and head + declared <= size:
            behind = file.read_at(min(SLACK + len(separator), size - head - declared), head + declared)
            place = behind.find(separator)
            if 0 <= place <= SLACK or (len(behind) <= SLACK):
                stop = head + declared
                raw = file.read_at(declared, head)
        yield at, stop, raw if following < size else _without_end(raw, declared)
        at = following + len(EMPTY_LINE)


class _Member:
    """One gzip member, unfolded as it is asked for."""

    def __init__(self, file: pa.NativeFile, at: int, size: int):
        self.file, self.at, self.size, self.data = file, at, size, bytearray()
        self.inflate, self.over = zlib.decompressobj(31), False

    def fill(self) -> bool:
        """Unfolds on; false at the member's end, which also a damaged or cut one has."""
        while not self.over and self.at < self.size:
            block = self.file.read_at(min(READ_BYTES, self.size - self.at), self.at)
            try:
                more = self.inflate.decompress(block)
            except zlib.error:
                self.over = True
                return False
            self.over = self.inflate.eof
            self.at += len(block) - len(self.inflate.unused_data)
            if more:
                self.data += more
                return True
        self.over = True
        return False

    def find(self, wanted: bytes, at: int) -> int:
        while True:
            found = self.data.find(wanted, at)
            if found >= 0:
                return found
            at = max(at, len(self.data) - len(wanted) + 1)
            if not self.fill():
                return len(self.data)

    def reach(self, stop: int) -> None:
        while len(self.data) < stop and self.fill():
            pass

    def records(self, version: bytes) -> Iterator[bytes]:
        line = version + CRLF
        separator = EMPTY_LINE + line
        self.reach(len(line))
        while self.data[: len(line)] == line:
            del self.data[: len(line)]
            stop = self.find(separator, 0)
            declared = declared_end(bytes(self.data[:stop]))
            if declared is not None and stop < declared <= MOST:
                self.reach(declared + SLACK + len(separator))
                place = self.data.find(separator, declared, declared + SLACK + len(separator))
                if place >= 0 or (declared <= len(self.data) <= declared + SLACK):
                    stop = place if place >= 0 else len(self.data)
            raw = bytes(self.data[:stop])
            yield raw if stop < len(self.data) else _without_end(raw, declared)
            self.reach(stop + len(EMPTY_LINE) + len(line))
            del self.data[: stop + len(EMPTY_LINE)]
        # The rest of a member that is not read further still has an end.
        while self.fill():
            self.data.clear()


def gzip_records(file: pa.NativeFile, start: int, end: int, version: bytes) -> Iterator[tuple[int, int | None, bytes]]:
    """The records of the members that begin in ``[start, end)``."""
    size, window = file.size(), ByteWindow(file, start, file.size())
    at = window.find(MAGIC, start)
    while at < min(end, size):
        member = _Member(file, at, size)
        member.reach(len(version))
        if member.data[: len(version)] == version:
            for raw in member.records(version):
                yield at, None, raw
            # After a damaged member the search goes on behind its magic bytes.
            after = member.at if member.inflate.eof else at + 1
        else:
            after = at + 1
        window.drop(after)
        at = window.find(MAGIC, after)


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.glob = options["path"], options.get("glob", "*.warc")
        self.version = options.get("version", "WARC/1.0").encode()
        self.width = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[ByteRange]:
        store, place = _open_store(self.path)
        info = store.get_file_info(place)
        files = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(place, recursive=True))
        scheme = self.path[: self.path.index(":") + 1] if re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", self.path) else "file:"
        named = [f for f in files if f.type == fs.FileType.File and fnmatch.fnmatchcase(f.base_name, self.glob)]
        # Hidden files are no archives, as for Spark's own readers.
        return [
            ByteRange(f"{scheme}//{f.path}" if scheme == "file:" else f"{scheme}//{f.path.lstrip('/')}", at, min(at + self.width, f.size))
            for f in named if f.base_name[0] not in "._" for at in range(0, f.size, self.width)
        ] or [ByteRange("", 0, 0)]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        store, place = _open_store(part.path)
        rows: list[tuple] = []
        held = 0
        with store.open_input_file(place) as file:
            parse = gzip_records if file.read_at(3, 0) == MAGIC else plain_records
            for at, stop, raw in parse(file, part.start, part.end, self.version):
                rows.append((at, stop, raw))
                held += len(raw)
                if held > BATCH_BYTES:
                    yield self._batch(part.path, rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(part.path, rows)

    @staticmethod
    def _batch(path: str, rows: list[tuple]) -> pa.RecordBatch:
        starts, stops, raws = zip(*rows)
        arrays = [pa.array([path] * len(rows)), pa.array(starts, pa.int64()), pa.array(stops, pa.int64()), pa.array(raws, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["file", "start", "stop", "raw"])


class ArchiveSource(DataSource):
    """``format("crawl_archive")`` with options ``path``, ``glob``, ``version`` and ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return "crawl_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader({k.lower(): v for k, v in self.options.items()})


def read_archives(spark: SparkSession, path: str, glob: str = "*.warc", version: str = "WARC/1.0", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file, start, stop, raw)``: every record from behind its version line, and the pieces inside completed ones."""
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format(ArchiveSource.name()).option("glob", glob).option("version", version)
    return reader.option("rangeBytes", range_bytes).load(path)


def outer_records(records: DataFrame, spans: DataFrame) -> DataFrame:
    """``records(file, start, ...)`` without those that begin inside another of ``spans(file, start, stop)``.

    A span that begins inside an earlier one does not count. Only offsets, of files that
    have a span, are put in order per file.
    """

    def outermost(rows):
        ordered, mask, reach = rows.sort_values("start"), [], -1
        for start, stop in zip(ordered["start"], ordered["stop"]):
            mask.append(start >= reach)
            reach = stop if start >= reach else reach
        return ordered[mask]

    outer = spans.groupBy("file").applyInPandas(outermost, "file string, start bigint, stop bigint")
    so_far = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    placed = records.select("file", "start").join(spans.select("file").distinct(), "file", "left_semi")
    inner = (
        placed.join(outer.select("file", "start", "stop", F.col("start").alias("record")), ["file", "start"], "left")
        .withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in ("record", "stop")})
        .where("start < stop AND start <> record")
        .select("file", "start")
    )
    return records.join(inner, ["file", "start"], "left_anti")
