"""Captured event streams as a data source, for batches and for streams.

spark.dataSource.register(Captures); spark.read.format("captures").load(folder), or readStream.

A capture is a file NAME.sse of the bytes that a server sent, perhaps still growing; a file NAME.end beside
it says that no more will come. Rows: capture (NAME), at (the byte at which the line begins), kind and payload:

    data   a payload line (the text behind "data:", trimmed)
    done   the sentinel; nothing behind it counts
    reset  the capture ended without the sentinel (its last line, if it lacks the newline, counts before that)

Comments, event lines, other fields, blank lines and empty payloads are no rows. Lines end at a newline, a
carriage return before it goes; a byte that is no UTF-8 becomes U+FFFD, as decoding is by whole lines.

A stream's offset holds the bytes of every capture that are told of, wherever they were cut: a task
takes the lines that end in its range and looks back for the beginning of the first. So rows don't depend on how
the bytes came, and a query that goes on from a checkpoint repeats none. Paths may be of any file system that pyarrow
reads (file, hdfs, s3 and others).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

_SCHEMA = "capture string, at long, kind string, payload string"
_DONE = b"[DONE]"
#: Bytes read at once, and rows of a batch.
_READ, _ROWS = 1 << 20, 4096


@dataclass
class Range(InputPartition):
    """The lines of a capture that end in its bytes from start to end; and, if it has closed since, how it ended."""

    name: str
    path: str
    start: int
    end: int
    closed: bool


def payload_of(line: bytes) -> tuple[str, str] | None:
    """(kind, payload) of a line without its newline; None if it is no row."""
    text = line.removesuffix(b"\r").decode("utf-8", "replace").rstrip()
    if not text.startswith("data:"):
        return None
    payload = text[5:].lstrip()
    if not payload:
        return None
    return ("done", "") if payload.encode() == _DONE else ("data", payload)


def _opened(path: str):
    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system, inner


def _lines(file, start: int, end: int) -> Iterator[tuple[int, bytes, bool]]:
    """(place, line, whole) of the lines of a file that end from start on and before end, and of a last one without a newline."""
    began, back = start, b""
    while began > 0:  # to the beginning of the line that start may have cut
        take = min(_READ, began)
        file.seek(began - take)
        head = file.read(take)
        at = head.rfind(b"\n")
        back = head[at + 1 :] + back
        began -= take - (at + 1)
        if at >= 0:
            break
    file.seek(start)
    place, kept, left = began, [back], end - start
    while left > 0:
        data = file.read(min(_READ, left))
        if not data:
            break
        left -= len(data)
        *whole, rest = data.split(b"\n")
        for x in whole:
            line = b"".join((*kept, x))
            yield place, line, True
            place, kept = place + len(line) + 1, []
        kept.append(rest)
    last = b"".join(kept)
    if last:
        yield place, last, False


def _done_before(file, end: int) -> bool:
    """Whether the sentinel's line ends before a byte."""
    return any(whole and payload_of(line) == ("done", "") for _, line, whole in _lines(file, 0, end))


def rows_of(part: Range) -> Iterator[tuple[str, int, str, str]]:
    system, path = _opened(part.path)
    with system.open_input_file(path) as file:
        if part.start and _done_before(file, part.start):
            return
        place = part.end
        for place, line, whole in _lines(file, part.start, part.end):
            if not whole and not part.closed:
                return
            found = payload_of(line)
            if found:
                yield part.name, place, *found
                if found[0] == "done":
                    return
        if part.closed:
            yield part.name, part.end, "reset", ""


def _batches(part: Range) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    schema = pa.schema([("capture", pa.string()), ("at", pa.int64()), ("kind", pa.string()), ("payload", pa.string())])
    made = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    for row in rows_of(part):
        rows.append(row)
        if len(rows) == _ROWS:
            yield made()
            rows = []
    if rows:
        yield made()


class _Folder:
    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")

    def listed(self) -> dict[str, dict]:
        """Bytes of every capture, and whether it has closed."""
        system, inner = _opened(self.path)
        files = {x.base_name: x.size for x in system.get_file_info(fs.FileSelector(inner)) if x.is_file}
        return {n.removesuffix(".sse"): {"bytes": size, "closed": n.removesuffix(".sse") + ".end" in files} for n, size in files.items() if n.endswith(".sse")}

    def ranges(self, start: dict, end: dict) -> list[Range]:
        out = []
        for name, now in sorted(end.items()):
            before = start.get(name, {"bytes": 0, "closed": False})
            if now != before and not before["closed"]:
                out.append(Range(name, f"{self.path}/{name}.sse", before["bytes"], now["bytes"], now["closed"]))
        return out


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder = _Folder(options)

    def partitions(self) -> list[Range]:
        """A capture is one response, and so one task; in a batch all captures have closed."""
        return self.folder.ranges({}, {n: x | {"closed": True} for n, x in self.folder.listed().items()})

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _batches(partition) if partition is not None else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder = _Folder(options)

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return self.folder.listed()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.folder.ranges(start, end)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _batches(partition)


class Captures(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captures"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options)
