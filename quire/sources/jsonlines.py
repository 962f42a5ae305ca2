"""JSON lines with the place each line comes from.

Spark's JSON reader packs files by size, so neither its partitions nor its rows follow the
stored order, and it turns a malformed line into a row of nulls. Here every line carries its
file and the offset of its first byte, which order a folder of any files the same way
whatever the split size, and lines that are no JSON object of the expected columns are told
apart from the others instead of passing as empty rows.

``format("jsonlines")`` is a Python Data Source: the driver lists the files, cuts them into
byte ranges of ``splitBytes`` and packs small ones together in name order; a task reads its
ranges in chunks and returns Arrow batches. A line belongs to the range its first byte lies
in. Compressed files (``.gz``) are one range each; their offsets count the decompressed bytes.
Names that start with ``_`` or ``.`` are left out, as Spark's own file sources do. Only the
lines pass through Python; parsing them is ``from_json`` in the JVM.
"""

from __future__ import annotations

import gzip
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LINES_SCHEMA = "src_file string, src_row bigint, line string, valid boolean"
SUFFIXES = (".json", ".jsonl", ".json.gz", ".jsonl.gz")
SPLIT_BYTES = 128 << 20
CHUNK = 4 << 20
# A longer line fails by its file and offset; Spark cannot hold a larger string either.
MAX_LINE_BYTES = 1 << 30


class _Local:
    def __init__(self, root: str):
        self.root = os.path.abspath(root)

    def files(self) -> Iterator[tuple[str, int]]:
        """Relative path and size of every file; the root itself, if it is one, has the empty path."""
        if os.path.isfile(self.root):
            yield "", os.path.getsize(self.root)
            return
        if not os.path.isdir(self.root):
            raise FileNotFoundError(f"no table at {self.root}")
        for at, folders, names in os.walk(self.root):
            folders[:] = [f for f in folders if not f.startswith(("_", "."))]
            for name in (n for n in names if not n.startswith(("_", "."))):
                path = os.path.join(at, name)
                yield os.path.relpath(path, self.root).replace(os.sep, "/"), os.path.getsize(path)

    def open(self, name: str):
        return open(os.path.join(self.root, name) if name else self.root, "rb")


class _Uri:
    def __init__(self, uri: str):
        from pyarrow import fs as pafs

        self.fs, self.root = pafs.FileSystem.from_uri(uri)
        self.kind, self.selector = pafs.FileType, pafs.FileSelector

    def files(self) -> Iterator[tuple[str, int]]:
        info = self.fs.get_file_info(self.root)
        if info.type == self.kind.NotFound:
            raise FileNotFoundError(f"no table at {self.root}")
        if info.type == self.kind.File:
            yield "", int(info.size)
            return
        for i in self.fs.get_file_info(self.selector(self.root, recursive=True)):
            name = i.path[len(self.root):].strip("/")
            if i.type == self.kind.File and not any(p.startswith(("_", ".")) for p in name.split("/")):
                yield name, int(i.size)

    def open(self, name: str):
        return self.fs.open_input_file(f"{self.root.rstrip('/')}/{name}" if name else self.root)


def _store(path: str):
    return _Uri(path) if "://" in path else _Local(path.removeprefix("file:"))


class _Ranges(InputPartition):
    """Byte ranges ``(file, start, end)``, in order; ``end`` None reads a compressed file whole."""

    def __init__(self, ranges: list[tuple[str, int, int | None]]):
        self.ranges = ranges


def line_blocks(f, start: int, end: int | None, chunk: int = CHUNK, limit: int = MAX_LINE_BYTES) -> Iterator[tuple[list[int], list[bytes]]]:
    """The lines of an open file whose first byte lies in ``[start, end)``, as blocks of offsets and lines."""
    at = start
    if start:  # the line that reaches into the range belongs to the one before
        f.seek(start - 1)
        at = start - 1
        while True:
            part = f.read(chunk)
            cut = part.find(b"\n")
            if not part or cut >= 0:
                at += cut + 1 if part else 0
                break
            at += len(part)
            if end is not None and at >= end:
                return
        if not part or (end is not None and at >= end):
            return
        f.seek(at)
    held: list[bytes] = []
    size = 0
    while end is None or at < end:
        part = f.read(chunk)
        cut = part.rfind(b"\n")
        if part and cut < 0:
            held.append(part)
            size += len(part)
            if size > limit:
                raise ValueError(f"a line of more than {limit} bytes at offset {at}")
            continue
        block = b"".join(held) + part[:max(cut, 0)]
        if not part and not block:
            return
        offsets, lines = [], []
        for line in block.split(b"\n"):
            if end is not None and at >= end:
                break
            offsets.append(at)
            lines.append(line)
            at += len(line) + 1
        yield offsets, lines
        if not part:
            return
        held, size = [part[cut + 1:]], len(part) - cut - 1


def _batches(name: str, blocks) -> Iterator:
    import pyarrow as pa

    for offsets, lines in blocks:
        kept = [(o, x) for o, x in zip(offsets, lines) if x and not x.isspace()]
        if kept and kept[0][0] == 0:
            kept[0] = (0, kept[0][1].removeprefix(b"\xef\xbb\xbf"))
        if not kept:
            continue
        raw = [x for _, x in kept]
        try:
            text, valid = pa.array(raw, pa.binary()).cast(pa.string()), [True] * len(raw)
        except pa.ArrowInvalid:  # some line is no UTF-8
            valid = []
            for x in raw:
                try:
                    x.decode()
                    valid.append(True)
                except UnicodeDecodeError:
                    valid.append(False)
            text = pa.array([x.decode(errors="replace") for x in raw], pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(kept), pa.string()), pa.array([o for o, _ in kept], pa.int64()), text, pa.array(valid, pa.bool_())],
            names=["src_file", "src_row", "line", "valid"])


class JsonLinesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))
        if self.split <= 0:
            raise ValueError("splitBytes must be positive")

    def partitions(self):
        files = sorted((n, s) for n, s in _store(self.path).files() if n == "" or n.endswith(SUFFIXES))
        out: list[_Ranges] = []
        held: list[tuple[str, int, int | None]] = []
        size = 0
        for name, length in files:
            whole = (name or self.path).endswith(".gz")
            for start in range(0, max(1, length), length + 1 if whole else self.split):
                end = min(length, start + self.split)
                if held and size + (length if whole else end - start) > self.split:
                    out.append(_Ranges(held))
                    held, size = [], 0
                held.append((name, start, None if whole else end))
                size += length if whole else end - start
        return [*out, _Ranges(held)]

    def read(self, partition: _Ranges):
        store = _store(self.path)
        for name, start, end in partition.ranges:
            with store.open(name) as raw:
                f = gzip.GzipFile(fileobj=raw) if end is None else raw
                label = name or self.path.rstrip("/").rsplit("/", 1)[-1]
                try:
                    yield from _batches(label, line_blocks(f, start, end))
                except (ValueError, EOFError, gzip.BadGzipFile) as e:
                    raise ValueError(f"cannot read {label}: {e}") from e


class JsonLinesSource(DataSource):
    """``spark.read.format("jsonlines").load(path)`` → ``src_file, src_row (byte offset), line, valid (UTF-8)``."""

    @classmethod
    def name(cls) -> str:
        return "jsonlines"

    def schema(self) -> str:
        return LINES_SCHEMA

    def reader(self, schema) -> JsonLinesReader:
        return JsonLinesReader(self.options)


def json_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every line that is not blank, with its place. Stores that only Spark's readers can open are read as text by these."""
    from quire.operators.select import with_position
    from quire.session import ship_package

    try:
        store = _store(path)
    except (ValueError, OSError, ImportError):  # a scheme that is no file system of pyarrow
        lines = with_position(spark.read.text(path)).withColumnRenamed("value", "line")
        return lines.where(F.trim("line") != "").select("src_file", "src_row", "line", F.lit(True).alias("valid"))
    if isinstance(store, _Local) and not os.path.exists(store.root):
        raise FileNotFoundError(f"no table at {path}")
    ship_package(spark)
    spark.dataSource.register(JsonLinesSource)
    return spark.read.format("jsonlines").option("path", path).option("splitBytes", str(split_bytes)).load()


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """``src_file, src_row, line, row, bad``: the lines parsed to a struct; ``bad`` where a line is no JSON object, or has a
    field that does not fit its column. Such a row's struct may hold part of the fields and is not to be used."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    j = lines.select("*", F.from_json("line", f"{schema}, _bad string", options).alias("row"))
    bad = ~F.col("valid") | F.col("row").isNull() | F.col("row._bad").isNotNull() | ~F.ltrim("line").startswith("{")
    return j.select("src_file", "src_row", "line", "row", F.coalesce(bad, F.lit(True)).alias("bad"))
