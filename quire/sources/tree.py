"""Source trees as tables.

Spark's own file sources silently drop names starting with ``_`` or ``.``
(``__init__.py``, ``.github/…``) and match globs case-sensitively, so a tree is
read with a Python Data Source (``format("sourcetree")``) that keeps every
regular file. Reading happens in two steps:

1. **listing** (``repo, path, size``): the driver expands only the top of the
   tree breadth-first, within a fixed budget of directory listings, and hands
   the remaining subtrees to tasks, so the listing itself is distributed and a
   huge subdirectory is not walked by the driver. The driver reads names alone; a folder
   of very many files is dealt by a hash of their names to several tasks, each of which looks at
   its own share of them. Filters on ``path`` and ``size`` (``startswith``, ``endswith``, comparisons) are
   pushed into the walk: subtrees that no asked path lies in are not listed, and files that
   are not asked for are not looked at;
2. **content**: after the name and size filters (plain column predicates), the
   surviving paths are spread over tasks and each task reads and decodes its
   files in Arrow batches (``mapInPandas``).

A root that is missing or cannot be listed fails when the plan is made. Below it, folders
and files that are gone or not permitted are skipped and counted: in the listing they are
rows of size ``UNLISTED``, in the contents null text under an observation. Every other
error (a timeout, a throttled store) fails its task, which Spark tries again.

The root must be visible to the driver and to every executor (a shared mount,
or any ``scheme://`` URI that ``pyarrow.fs`` can open).
"""

from __future__ import annotations

import os
import time
import uuid
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from quire.functions.decode import decode_bytes

LISTING_SCHEMA = "repo string, path string, size bigint"
FILES_SCHEMA = "repo string, path string, size bigint, text string"
VCS_DIR = ".git"


# ---------------------------------------------------------------------------
# File-system access: os.scandir for local / mounted paths, pyarrow.fs for URIs.


# Size of a listing row that stands for a folder or file that could not be looked at.
UNLISTED = -1
_SKIPPED_ERRORS = (FileNotFoundError, PermissionError, NotADirectoryError)


class _LocalFs:
    def list(self, d: str, want=None) -> Iterator[tuple[str, str, int]]:
        """Entries of a folder as (name, "d" | "f" | "?", size), one at a time; files that ``want(name)`` refuses are left out unlooked at."""
        with os.scandir(d) as it:
            for e in it:
                try:
                    if e.is_dir(follow_symlinks=False):
                        yield (e.name, "d", 0)
                    elif (want is None or want(e.name)) and e.is_file():  # follows a symlink to a regular file
                        yield (e.name, "f", int(e.stat().st_size))
                except _SKIPPED_ERRORS:
                    yield (e.name, "?", UNLISTED)

    def changed(self, p: str) -> int:
        """When a file's content or name last changed, in ns."""
        st = os.stat(p)
        return max(st.st_mtime_ns, st.st_ctime_ns)

    def names(self, d: str) -> Iterator[tuple[str, bool]]:
        """Names in a folder and whether they are folders; nothing is looked at."""
        with os.scandir(d) as it:
            for e in it:
                try:
                    yield (e.name, e.is_dir(follow_symlinks=False))
                except _SKIPPED_ERRORS:
                    yield (e.name, False)

    def read(self, p: str) -> bytes:
        with open(p, "rb") as fh:
            return fh.read()

    @staticmethod
    def join(d: str, name: str) -> str:
        return os.path.join(d, name)


class _ArrowFs:
    def __init__(self, uri: str):
        from pyarrow import fs as pafs

        self._pafs = pafs
        self.fs, self.root = pafs.FileSystem.from_uri(uri)

    def list(self, d: str, want=None) -> Iterator[tuple[str, str, int]]:
        """Entries of a folder; the store answers with one folder's entries, sizes included, at once."""
        for i in self.fs.get_file_info(self._pafs.FileSelector(d, recursive=False)):
            if i.type == self._pafs.FileType.Directory:
                yield (i.base_name, "d", 0)
            elif i.type == self._pafs.FileType.File and (want is None or want(i.base_name)):
                yield (i.base_name, "f", int(i.size or 0))

    def changed(self, p: str) -> int:
        return self.fs.get_file_info(p).mtime_ns or 0

    def names(self, d: str) -> Iterator[tuple[str, bool]]:
        for name, kind, _ in self.list(d):
            yield (name, kind == "d")

    def read(self, p: str) -> bytes:
        with self.fs.open_input_stream(p) as fh:
            return fh.read()

    @staticmethod
    def join(d: str, name: str) -> str:
        return d.rstrip("/") + "/" + name


def _open(root: str):
    if "://" in root:
        afs = _ArrowFs(root)
        return afs, afs.root
    return _LocalFs(), os.path.abspath(root)


# ---------------------------------------------------------------------------
# Data source


# Files of one folder above which their listing is dealt to several tasks, and the most it is dealt to.
FOLDER_FILES = 10_000
MAX_SHARES = 256


class _Units(InputPartition):
    """A group of listing units ``(relative dir, recursive, share, shares)``: a folder's own files (those of one
    share of their names), or all below it; in a stream, those last changed after ``after`` and up to ``upto`` (ns)."""

    def __init__(self, units: list[tuple[str, bool, int, int]], after: int | None = None, upto: int | None = None):
        self.units, self.after, self.upto = units, after, upto


def _rel(parent: str, name: str) -> str:
    return f"{parent}/{name}" if parent else name


class _Asked:
    """What of a tree is asked for: pushed filters, and the listing's own options."""

    def __init__(self, extensions: tuple[str, ...] = (), max_bytes: int | None = None):
        self.extensions, self.max_bytes = extensions, max_bytes
        self.prefixes: list[str] = []
        self.tests: list[tuple[str, str, object]] = []  # column, operation, value

    def folder(self, rel: str) -> bool:
        """Whether asked paths can lie below a folder."""
        own = rel + "/"
        return not rel or all(own.startswith(p) or p.startswith(own) for p in self.prefixes)

    def name(self, rel: str, name: str) -> bool:
        """Whether a file can be asked for, by its name alone."""
        path = _rel(rel, name)
        return (not self.extensions or name.lower().endswith(self.extensions)) and all(
            _TESTS[op](path, value) for column, op, value in self.tests if column == "path")

    def size(self, size: int) -> bool:
        if size == UNLISTED:  # told unless a pushed filter asks for sizes
            return all(_TESTS[op](size, value) for column, op, value in self.tests if column == "size")
        return (self.max_bytes is None or 0 < size <= self.max_bytes) and all(
            _TESTS[op](size, value) for column, op, value in self.tests if column == "size")


_TESTS = {
    "EqualTo": lambda x, v: x == v, "GreaterThan": lambda x, v: x > v, "GreaterThanOrEqual": lambda x, v: x >= v,
    "LessThan": lambda x, v: x < v, "LessThanOrEqual": lambda x, v: x <= v, "In": lambda x, v: x in v,
    "StringStartsWith": lambda x, v: x.startswith(v), "StringEndsWith": lambda x, v: x.endswith(v), "StringContains": lambda x, v: v in x,
}


class SourceTreeReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.root = options["path"]
        self.repo = options.get("repo") or os.path.basename(self.root.rstrip("/"))
        self.prune_vcs = str(options.get("prunevcs", options.get("pruneVcs", "true"))).lower() == "true"
        self.budget = int(options.get("listingbudget", options.get("listingBudget", 64)))
        self.num_partitions = int(options.get("numpartitions", options.get("numPartitions", 16)))
        self.folder_files = int(options.get("folderfiles", options.get("folderFiles", FOLDER_FILES)))
        most = options.get("maxbytes", options.get("maxBytes"))
        self.asked = _Asked(tuple(x.lower() for x in (options.get("extensions") or "").split(",") if x), None if most is None else int(most))

    def _walked(self, rel: str, name: str) -> bool:
        return not (self.prune_vcs and name == VCS_DIR) and self.asked.folder(_rel(rel, name))

    def partitions(self):
        """Breadth-first expansion of the top of the tree, at most ``budget``
        directory listings on the driver; unexpanded subtrees become recursive units."""
        fs, root = _open(self.root)
        units: list[tuple[str, bool, int, int]] = []
        queue: deque[str] = deque([""])
        listed = 0
        while queue and listed < self.budget:
            rel = queue.popleft()
            listed += 1
            files = 0
            try:  # names pass one at a time; only those of folders are kept
                for name, is_folder in fs.names(fs.join(root, rel) if rel else root):
                    if not is_folder:
                        files += 1
                    elif self._walked(rel, name):
                        queue.append(_rel(rel, name))
            except _SKIPPED_ERRORS as e:
                if not rel:
                    raise ValueError(f"cannot list the source tree {self.root}: {e}") from e
                # the task that lists this folder counts it
            shares = min(MAX_SHARES, max(1, -(-files // self.folder_files)))
            units.extend((rel, False, i, shares) for i in range(shares))  # this directory's own files
        units.extend((rel, True, 0, 1) for rel in queue)
        n = max(1, min(max(self.num_partitions, max((u[3] for u in units), default=1)), len(units)))
        groups: list[list[tuple[str, bool, int, int]]] = [[] for _ in range(n)]
        for i, u in enumerate(units):
            groups[i % n].append(u)
        return [_Units(g) for g in groups]

    def read(self, partition: _Units) -> Iterator[tuple]:
        from zlib import crc32

        fs, root = _open(self.root)
        for rel_dir, recursive, share, shares in partition.units:
            stack = [rel_dir]
            while stack:
                rel = stack.pop()

                def want(name: str) -> bool:
                    return (shares == 1 or crc32(os.fsencode(name)) % shares == share) and self.asked.name(rel, name)  # noqa: B023

                try:
                    for name, kind, size in fs.list(fs.join(root, rel) if rel else root, want):
                        if kind == "d":
                            if recursive and self._walked(rel, name):
                                stack.append(_rel(rel, name))
                        elif (kind == "f" or shares == 1 or share == 0) and self.asked.size(size):
                            if partition.upto is None or self._lately(fs, fs.join(root, _rel(rel, name)), kind, partition):
                                yield (self.repo, _rel(rel, name), size)
                except _SKIPPED_ERRORS:
                    if share == 0 and partition.upto is None and self.asked.size(UNLISTED):
                        yield (self.repo, rel, UNLISTED)

    @staticmethod
    def _lately(fs, path: str, kind: str, partition: _Units) -> bool:
        try:
            return kind == "f" and partition.after < fs.changed(path) <= partition.upto
        except _SKIPPED_ERRORS:  # gone since it was listed
            return False


class PushingReader(SourceTreeReader):
    """The reader where the session lets Python data sources take filters."""

    def pushFilters(self, filters):
        for f in filters:
            op, column = type(f).__name__, getattr(f, "attribute", ())
            value = getattr(f, "value", None)
            if column in (("path",), ("size",)) and op in _TESTS and value is not None and not (op == "In" and None in value):
                self.asked.tests.append((column[0], op, value))
                if column == ("path",) and op in ("StringStartsWith", "EqualTo"):
                    self.asked.prefixes.append(value)
            elif op != "IsNotNull" or column not in (("path",), ("size",), ("repo",)):  # none of the columns is ever null
                yield f


class SourceTreeStreamReader(DataSourceStreamReader):
    """Files of a tree as they are added or changed. An offset is a time: a batch holds the files last changed after the
    batch before it and up to its own time, so it is told by two numbers, and the tasks that list the tree find
    them again after a restart. Times lie ``settleSeconds`` back, so that what was written in the meantime,
    by other machines with other clocks too, is in the listing. A file that changes again before its
    batch is read appears in a later one. Each trigger lists the tree once, in tasks."""

    def __init__(self, options: dict, schema):
        self.inner = SourceTreeReader(options, schema)
        self.settle = int(float(options.get("settleseconds", options.get("settleSeconds", 5))) * 1e9)

    def initialOffset(self) -> dict:
        return {"changed": 0}

    def latestOffset(self) -> dict:
        return {"changed": time.time_ns() - self.settle}

    def partitions(self, start: dict, end: dict):
        return [_Units(p.units, int(start["changed"]), int(end["changed"])) for p in self.inner.partitions()]

    def read(self, partition: _Units) -> Iterator[tuple]:
        yield from self.inner.read(partition)


class SourceTreeDataSource(DataSource):
    """``spark.read.format("sourcetree").option("repo", label).load(root)`` →
    ``repo, path (relative, '/'-separated), size (bytes)`` for every regular file."""

    @classmethod
    def name(cls) -> str:
        return "sourcetree"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> SourceTreeReader:
        pushed = str(self.options.get("pushdown", "false")).lower() == "true"
        return (PushingReader if pushed else SourceTreeReader)(self.options, schema)

    def streamReader(self, schema) -> SourceTreeStreamReader:
        return SourceTreeStreamReader(self.options, schema)


def listed():
    """Listing rows that are files; the others stand for what could not be looked at."""
    return F.col("size") != UNLISTED


PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"


def register(spark: SparkSession) -> None:
    from quire.session import ship_package

    ship_package(spark)
    spark.dataSource.register(SourceTreeDataSource)


def list_tree(
    spark: SparkSession,
    root: str,
    repo: str | None = None,
    num_partitions: int | None = None,
    *,
    extensions: tuple[str, ...] = (),
    max_bytes: int | None = None,
) -> DataFrame:
    """Listing of a tree; the walk is spread over ``num_partitions`` listing tasks
    (default: the cluster's default parallelism).

    Filters on the result's ``path`` and ``size`` are pushed into the walk where the session allows
    it (``PUSHDOWN_CONF``). With ``extensions`` (in any case) and ``max_bytes`` other files, and empty ones, are left
    out of the listing; what could not be looked at is still in it.
    """
    register(spark)
    reader = spark.read.format("sourcetree").option("path", root)
    if repo is not None:
        reader = reader.option("repo", repo)
    if extensions:
        reader = reader.option("extensions", ",".join(extensions))
    if max_bytes is not None:
        reader = reader.option("maxBytes", str(int(max_bytes)))
    n = num_partitions or spark.sparkContext.defaultParallelism
    reader = reader.option("numPartitions", str(n)).option("listingBudget", str(max(64, 4 * n)))
    return reader.option("pushdown", spark.conf.get(PUSHDOWN_CONF, "false")).load()


def stream_tree(spark: SparkSession, root: str, repo: str | None = None, num_partitions: int | None = None, settle_seconds: float = 5.0) -> DataFrame:
    """The listing of a tree as a stream: each file once when it is there, and again whenever it changes, across restarts
    of a query with the same checkpoint."""
    register(spark)
    n = num_partitions or spark.sparkContext.defaultParallelism
    reader = spark.readStream.format("sourcetree").option("path", root).option("settleSeconds", str(settle_seconds))
    if repo is not None:
        reader = reader.option("repo", repo)
    return reader.option("numPartitions", str(n)).option("listingBudget", str(max(64, 4 * n))).load()


# Bytes of file text per output batch of the reading step, and per reading task.
OUTPUT_BATCH_BYTES = 32 << 20
TASK_BYTES = 128 << 20


def _reader(root: str, batch_bytes: int = OUTPUT_BATCH_BYTES):
    def read_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, abs_root = _open(root)
        for pdf in batches:
            start, acc, texts = 0, 0, []
            for i, p in enumerate(pdf["path"]):
                try:
                    t = decode_bytes(fs.read(fs.join(abs_root, p)))
                except _SKIPPED_ERRORS:
                    t = None
                texts.append(t)
                acc += len(t) if t else 0
                if acc >= batch_bytes:  # bound the Arrow batch by bytes, not rows
                    yield pdf.iloc[start : i + 1].assign(text=texts)
                    start, acc, texts = i + 1, 0, []
            if start < len(pdf):
                yield pdf.iloc[start:].assign(text=texts)

    return read_batches


def read_contents(listing: DataFrame, root: str, num_partitions: int | None = None) -> DataFrame:
    """Read and decode the files of a (filtered) listing: adds ``text``; files that
    cannot be read get null text.

    The listing is spread by path over tasks first (a shuffle of small metadata
    rows only), so one big directory does not end up in one reading task. Without
    ``num_partitions`` the task count follows the listed bytes (about
    ``TASK_BYTES`` per task, at least the default parallelism), taken from the
    checkpointed listing. Output batches are cut by bytes.
    """
    from quire.session import checkpoint_dir, ship_package

    spark = listing.sparkSession
    ship_package(spark)
    n = num_partitions
    if n is None:
        # Materialised once in the shared checkpoint folder: sizing the tasks and
        # reading then share one walk of the tree (and its lineage is cut, so a lost
        # executor does not re-walk it).
        checkpoint_dir(spark)
        listing = listing.checkpoint(eager=True)
        total = listing.agg(F.sum("size").alias("b")).first()["b"] or 0
        n = max(spark.sparkContext.defaultParallelism, -(-int(total) // TASK_BYTES))
    spread = listing.repartition(int(n), "path")
    return spread.mapInPandas(_reader(root), FILES_SCHEMA)


def readable(files: DataFrame, name: str = "source_read") -> tuple[DataFrame, Observation]:
    """Drop unreadable files, counting them: ``obs.get["unreadable"]`` after an action."""
    obs = Observation(f"{name}_{uuid.uuid4().hex}")
    observed = files.observe(
        obs, F.count(F.lit(1)).alias("files"), F.count_if(F.col("text").isNull()).alias("unreadable")
    )
    return observed.where(F.col("text").isNotNull()), obs
