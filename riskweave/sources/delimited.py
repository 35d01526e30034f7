"""Delimited text as a Spark data source whose partitions find their columns themselves.

A partition is a range of bytes of one file. It reads that file's first line for the header, then only
its own lines, and parses only the wanted columns, so files of one folder may order their columns
differently and no job runs before the scan.
"""

from __future__ import annotations

import csv
import io
import json
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

#: Bytes of a partition, and bytes in which a file's first line must end at first (then twice that, and so on).
PART_BYTES, HEAD_BYTES = 64 << 20, 1 << 16
#: Schemes of addresses that Python reads by itself.
SCHEMES = {"file", "hdfs", "viewfs", "s3", "s3a", "gs"}
_PACKED = (".gz", ".bz2", ".zst", ".lz4")


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a qualified address."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), parts.path
    return pyarrow.fs.FileSystem.from_uri("s3" + uri[3:] if parts.scheme == "s3a" else uri)


def data_files(uri: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files below an address that hold data, in the order of their names."""
    fs, path = file_system(uri)
    info = fs.get_file_info(path)
    if info.type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    if info.type == pyarrow.fs.FileType.File:
        return [(info.path, info.size)]
    below = fs.get_file_info(pyarrow.fs.FileSelector(path, recursive=True))
    shown = [f for f in below if f.type == pyarrow.fs.FileType.File and f.size
             and not any(p[:1] in "._" for p in posixpath.relpath(f.path, path).split("/"))]
    return sorted((f.path, f.size) for f in shown)


def read_header(fs: pyarrow.fs.FileSystem, path: str, sep: str) -> tuple[list[str], int]:
    """Column names of a file and the bytes of its first line."""
    size = HEAD_BYTES
    with fs.open_input_stream(path, compression="detect" if path.endswith(_PACKED) else None) as f:
        raw = f.read(size)
        while b"\n" not in raw and (more := f.read(size)):
            raw += more
            size *= 2
    line = raw.partition(b"\n")[0]
    names = next(csv.reader([line.decode("utf-8-sig").rstrip("\r")], delimiter=sep), [])
    return [n.strip() for n in names], len(line) + 1


def check_header(names: list[str], wanted: list[str], path: str) -> None:
    missing = [c for c in wanted if c not in names]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")


def lines_between(f: pa.NativeFile, size: int, start: int, end: int) -> bytes:
    """The lines that begin in the bytes from ``start`` up to ``end``."""
    f.seek(max(start - 1, 0))
    if start:
        raw = f.read(min(end, size) - start + 1)
        cut = raw.find(b"\n")
        if cut < 0:
            return b""  # one line covers the whole range
        raw = raw[cut + 1:]
    else:
        raw = f.read(min(end, size))
    if not raw:
        return b""
    while not raw.endswith(b"\n") and (more := f.read(HEAD_BYTES)):  # the last line ends beyond the range
        head, found, _ = more.partition(b"\n")
        raw += head + found
        if found:
            break
    return raw


def parse(raw: bytes, names: list[str], wanted: list[str], sep: str) -> Iterator[pa.RecordBatch]:
    """The wanted columns as texts. Lines with fewer fields end in missing ones; lines with more are an error."""
    schema = pa.schema([(c, pa.string()) for c in wanted])
    if not raw.strip():
        return
    try:
        table = pa.csv.read_csv(
            io.BytesIO(raw), pa.csv.ReadOptions(column_names=[f"c{i}" for i in range(len(names))], block_size=max(len(raw), 1 << 20), use_threads=False),
            pa.csv.ParseOptions(delimiter=sep),
            pa.csv.ConvertOptions(include_columns=[f"c{names.index(c)}" for c in wanted], column_types={f"c{i}": pa.string() for i in range(len(names))}))
        table = table.rename_columns(wanted)
    except pa.ArrowInvalid:
        rows = [r for r in csv.reader(io.StringIO(raw.decode()), delimiter=sep) if r]
        long = next((r for r in rows if len(r) > len(names)), None)
        if long:
            raise ValueError(f"more fields than columns: {long}") from None
        table = pa.table([pa.array([r[i] if i < len(r) else None for r in rows], pa.string()) for i in map(names.index, wanted)], schema)
    yield from table.to_batches(10_000)


@dataclass
class FileRange(InputPartition):
    path: str
    size: int
    start: int
    end: int | None


class DelimitedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.sep = options["path"], options.get("sep", ",")
        self.wanted, self.part_bytes = json.loads(options["columns"]), int(options.get("part_bytes", PART_BYTES))

    def partitions(self) -> list[FileRange]:
        out = []
        for path, size in data_files(self.uri):
            if path.endswith(_PACKED):
                out.append(FileRange(path, size, 0, None))
            else:
                out += [FileRange(path, size, a, a + self.part_bytes) for a in range(0, size, self.part_bytes)]
        return out or [FileRange("", 0, 0, 0)]

    def read(self, part: FileRange) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        fs, _ = file_system(self.uri)
        names, head = read_header(fs, part.path, self.sep)
        check_header(names, self.wanted, part.path)
        if part.end is None:
            with fs.open_input_stream(part.path, compression="detect") as f:
                raw = f.read()[head:]
        else:
            with fs.open_input_file(part.path) as f:
                raw = lines_between(f, part.size, part.start, part.end)
            if part.start < head:  # the header is the first line of the first range
                raw = raw[head:] if part.start == 0 else raw
        yield from parse(raw, names, self.wanted, self.sep)


class DelimitedSource(DataSource):
    """Format ``delimited``: options ``path`` (qualified), ``sep``, ``columns`` (a JSON list), ``part_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "delimited"

    def schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in json.loads(self.options["columns"])])

    def reader(self, schema: StructType) -> DelimitedReader:
        return DelimitedReader(dict(self.options))
