"""Table sources: the input tables with explicit schemas, the prepared-table sink
and reload, and the views derived from the input tables.

Explicit schemas mean no inference job and a plan-time error on a wrong file.
Every reader selects only what the caller asks for, so Parquet column pruning
and filter pushdown reach the scan.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.operators.select import pick_split, with_position
from quire.sources.jsonlines import SPLIT_BYTES, json_lines, parsed

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``{root}/{name}.parquet`` with its fixed schema."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(os.path.join(root, f"{name}.parquet"))


def scan_conversations(spark: SparkSession, path: str, split: str | None = None, fmt: str = "parquet", split_col: str = "split") -> DataFrame:
    """Load a conversation table; with ``split``, keep that split (partition pruning
    on a ``split``-partitioned layout)."""
    df = open_table(spark, path, fmt)
    if split is not None:
        df = df.where(F.col(split_col) == F.lit(split))
    return df


# Columns that JSON rows may have: giving them spares a pass over the input to infer them.
JSON_SCHEMA = (
    "id string, split string, messages array<struct<role:string,content:string,thinking:string>>, "
    "conversations array<struct<from:string,value:string>>, conv_id bigint, turn bigint, role string, text string, "
    "developer string, user_text string"
)
# Of these a table has one kind; the first whose columns hold a value names it.
JSON_KINDS = (("messages",), ("conversations",), ("conv_id", "turn", "role", "text"), ("developer", "user_text"))


@dataclass
class Rejected:
    """What reading a text table found: its lines, how many were rejected, and these as rows
    ``src_file, src_row (byte offset), line`` (a side table to write, or None for other formats)."""

    lines: int = 0
    rejected: int = 0
    rows: DataFrame | None = None


def open_table(spark: SparkSession, path: str, fmt: str | None = None, *, position: bool = False, max_bad_share: float = 0.0,
               rejected: Rejected | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A table of any kind the engine reads: Parquet, or JSON lines (by name, or as the files of a folder).

    JSON is read with the fixed columns above. One aggregate over all rows tells their kind, and columns of
    other kinds go; rows of more than one kind are an error. An ``id`` or ``split`` stays if any row has one.
    The same aggregate counts malformed lines. They are no rows of the table; more of them than ``max_bad_share`` of
    all lines (by default, any) are an error that names the first, before anything is made of the table.
    ``rejected`` receives the counts and the lines. With ``position``, rows carry ``src_file`` and ``src_row``, their
    place in stored order.
    """
    if fmt in (None, "parquet") and not _is_json(spark, path):
        df = spark.read.parquet(published_dir(spark, path))
        return with_position(df) if position else df
    lines = parsed(json_lines(spark, path, split_bytes), JSON_SCHEMA)
    good = lines.where(~F.col("bad")).select("src_file", "src_row", "row.*")
    kind_of = F.coalesce(*(F.when(_any_value(k, "row."), F.lit(i)) for i, k in enumerate(JSON_KINDS)))
    fine = ~F.col("bad")
    seen = lines.agg(
        F.sort_array(F.collect_set(F.when(fine, kind_of))).alias("kinds"), *(F.bool_or(fine & F.col(f"row.{c}").isNotNull()).alias(c) for c in ("id", "split")),
        F.count("*").alias("lines"), F.count_if("bad").alias("bad"), F.min(F.when(F.col("bad"), F.struct("src_file", "src_row"))).alias("first")).first()
    if rejected is not None:
        rejected.lines, rejected.rejected = seen["lines"], seen["bad"]
        rejected.rows = lines.where("bad").select("src_file", "src_row", "line")
    if seen["bad"] > max_bad_share * seen["lines"]:
        at = seen["first"]
        raise ValueError(f"{path}: {seen['bad']} of {seen['lines']} lines are malformed, the first at byte {at['src_row']} of {at['src_file']}; "
                         f"a share of {max_bad_share} is allowed")
    if len(seen["kinds"]) > 1:
        raise ValueError(f"{path} has rows of more than one kind: " + "; ".join(", ".join(JSON_KINDS[i]) for i in seen["kinds"]))
    kind = JSON_KINDS[seen["kinds"][0]] if seen["kinds"] else JSON_KINDS[0]
    return good.select(*(c for c in ("id", "split") if seen[c]), *kind, *(["src_file", "src_row"] if position else []))


def _any_value(columns: tuple[str, ...], of: str = ""):
    """Whether a row has a value in any of the columns."""
    return F.coalesce(*(F.when(F.col(of + c).isNotNull(), True) for c in columns), F.lit(False))


def _is_json(spark: SparkSession, path: str) -> bool:
    if path.endswith((".json", ".jsonl")):
        return True
    fs, at = _hadoop(spark, path)
    if not fs.exists(at) or fs.getFileStatus(at).isFile():
        return False
    files = fs.listFiles(at, True)  # lazily: the first data file tells
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return name.endswith((".json", ".jsonl", ".json.gz", ".jsonl.gz"))
    return False


MESSAGES_SCHEMA = "messages array<struct<role:string,content:string>>"


def from_rows(spark: SparkSession, rows: list[dict], schema: str = MESSAGES_SCHEMA) -> DataFrame:
    """A small DataFrame from in-memory rows with a fixed schema (e.g. hand-written
    message lists). Large inputs belong in files read by Spark, not the driver."""
    return spark.createDataFrame(rows, schema)


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at  # noqa: SLF001


# A prepared table is a folder of versions, ``published=<id>``, and of empty marker files whose names tell which of
# them is current. Making a marker is one atomic step on every store: nothing is renamed or overwritten.
VERSION = "published="
MARKER = "_published."
# A version without a marker may be one that is being written; older ones are left from runs that were killed.
UNUSED_MS = 24 * 3600 * 1000


def _markers(fs, target) -> list[tuple[str, str]]:
    """(sequence number, version id) of the markers in a table's folder, the current one last."""
    if not fs.exists(target) or not fs.getFileStatus(target).isDirectory():
        return []
    names = (st.getPath().getName() for st in fs.listStatus(target))
    return sorted(tuple(n[len(MARKER):].split(".", 1)) for n in names if n.startswith(MARKER))


def published_dir(spark: SparkSession, table_dir: str) -> str:
    """The folder that holds a table's current version: the one its last marker names, or ``table_dir`` itself for a plain table."""
    fs, target = _hadoop(spark, table_dir)
    marks = _markers(fs, target)
    return f"{table_dir.rstrip('/')}/{VERSION}{marks[-1][1]}" if marks else table_dir


def publish(spark: SparkSession, table_dir: str, version: str, step=lambda name: None) -> None:
    """Make ``published=<version>`` the current version of a table, then drop what was there before.

    Readers see the old table until the marker is there and the new one from then on. A driver lost before leaves
    the old table and an unused folder, one lost later leaves old versions that nothing reads; later publications
    drop these, the folder after a day. Of two that publish at once the greater name is current, whole in any
    case, as only versions with a lesser marker go. ``step`` is called with the name of each step before it is taken.
    """
    fs, target = _hadoop(spark, table_dir)
    marks = _markers(fs, target)
    number = int(marks[-1][0]) + 1 if marks else 0
    step("mark")
    mark = (f"{number:012d}", version)
    if not fs.createNewFile(_hadoop(spark, f"{table_dir.rstrip('/')}/{MARKER}{'.'.join(mark)}")[1]):
        raise OSError(f"cannot mark {version} in {table_dir}")
    marks = _markers(fs, target)
    done, late = {m for m in marks if m < max(marks)}, spark._jvm.System.currentTimeMillis() - UNUSED_MS  # noqa: SLF001
    gone = {VERSION + v for _, v in done - {mark}}, {MARKER + ".".join(m) for m in done - {mark}}
    used = {VERSION + v for _, v in marks}
    entries = {st.getPath().getName(): st for st in fs.listStatus(target)}
    unused = [n for n, st in entries.items() if n.startswith(VERSION) and n not in used and st.getModificationTime() <= late]
    plain = [n for n in entries if not n.startswith((VERSION, MARKER)) and not n.startswith(".")]
    # data before markers: a marker never names less than a whole version unless a later one is there
    for name in [*plain, *unused, *sorted(gone[0] & entries.keys()), *sorted(gone[1] & entries.keys())]:
        step(f"drop {name}")
        fs.delete(entries[name].getPath(), True)


def write_prepared(df: DataFrame, out_dir: str, *, overwrite: bool = True, split_col: str | None = "split", step=lambda name: None) -> int:
    """Persist a prepared table and return its rows, counted by an observation during the write.

    The table is written as a version of its own inside the target folder and becomes current by one marker file when
    it is complete, so a run that fails or is killed at any step leaves the old or the new table, whole; so
    does an empty one, which raises if there is a table and else leaves an empty one that can be read.
    An existing target is replaced only with ``overwrite=True``; otherwise the write fails before it starts.
    Read it with ``load_prepared`` or ``read_published``; to other readers the folder is a table partitioned
    by ``published``, with one version except while one takes over from another or after a killed run.
    """
    spark = df.sparkSession
    fs, target = _hadoop(spark, out_dir)
    exists = fs.exists(target) and fs.listStatus(target) and any(
        not st.getPath().getName().startswith(VERSION) for st in fs.listStatus(target))  # versions that nothing marks are no table
    if exists and not overwrite:
        raise FileExistsError(f"{out_dir} exists; it is replaced only on request")
    version = uuid.uuid4().hex
    data_dir = f"{out_dir.rstrip('/')}/{VERSION}{version}"
    data = _hadoop(spark, data_dir)[1]
    obs = Observation(f"prepared_{version}")
    try:
        step("write")
        writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write
        if split_col and split_col in df.columns:
            writer = writer.partitionBy(split_col)
        writer.parquet(data_dir)
        rows = int(obs.get["rows"])
        if rows == 0:
            if exists:
                raise ValueError(f"the run made no rows; {out_dir} is left as it was")
            spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(data_dir)
    except Exception:
        fs.delete(data, True)
        if not exists and fs.exists(target) and not fs.listStatus(target):
            fs.delete(target, True)
        raise
    publish(spark, out_dir, version, step)
    return rows


def read_published(spark: SparkSession, table_dir: str) -> DataFrame:
    """The current version of a table; a missing folder fails with a clear message."""
    fs, target = _hadoop(spark, table_dir)
    if not fs.exists(target):
        raise FileNotFoundError(f"no prepared table at {table_dir}")
    return spark.read.parquet(published_dir(spark, table_dir))


def load_prepared(spark: SparkSession, in_dir: str, prefer: str = "train", split_col: str = "split") -> DataFrame:
    """Reload a prepared table; with several splits take ``prefer`` if present, else
    the least split name. A missing folder fails with a clear message.

    The split names are the ``split=...`` folder names of the current version (one
    directory listing, a handful of names), so the choice becomes a literal
    filter and Spark prunes every other partition at planning time.
    """
    from urllib.parse import unquote

    df = read_published(spark, in_dir)
    fs, at = _hadoop(spark, published_dir(spark, in_dir))
    prefix = split_col + "="
    splits = sorted(
        unquote(st.getPath().getName()[len(prefix):])
        for st in fs.listStatus(at)
        if st.isDirectory() and st.getPath().getName().startswith(prefix)
    )
    if not splits:
        return pick_split(df, split_col, prefer).drop(split_col) if split_col in df.columns else df
    chosen = prefer if prefer in splits else splits[0]
    return df.where(F.col(split_col) == F.lit(chosen)).drop(split_col)


# ---------------------------------------------------------------------------
# Views derived from the input tables (the same rules are written as SQL for the
# DuckDB oracle in ``__spark_entry__``).


def source_files(documents: DataFrame) -> DataFrame:
    """Documents as files of a source tree: ``repo, path, size (bytes), text``.

    The path gets a ``.git`` / ``.github`` / ``pkg`` folder, an optional ``_``
    name prefix and one of four extensions from the document id.
    """
    d = F.col("doc_id")
    folder = F.when(d % 10 == 0, F.lit(".git/")).when(d % 10 == 1, F.lit(".github/")).otherwise(F.lit("pkg/"))
    prefix = F.when(d % 6 == 0, F.lit("_")).otherwise(F.lit(""))
    m4 = d % 4
    ext = (
        F.when(m4 == 0, F.lit(".py")).when(m4 == 1, F.lit(".md")).when(m4 == 2, F.lit(".txt")).otherwise(F.lit(".PY"))
    )
    return documents.select(
        F.col("source").alias("repo"),
        F.concat(folder, prefix, d.cast("string"), ext).alias("path"),
        F.octet_length("text").cast("bigint").alias("size"),
        F.col("text"),
    )


def dataset_specs(pages: DataFrame) -> DataFrame:
    """Four kinds of dataset specs from page URLs and ids: ``page_id, spec``."""
    p = F.col("page_id")
    pid = p.cast("string")
    spec = (
        F.when(p % 4 == 0, F.col("url"))
        .when(p % 4 == 1, F.concat(F.lit("repo:owner/"), pid, F.lit(".git")))
        .when(p % 4 == 2, F.concat(F.lit("owner/"), pid, F.lit(".git")))
        .otherwise(F.concat(F.lit(" git@host:o/"), pid, F.lit(".git ")))
    )
    return pages.select("page_id", spec.alias("spec"))


# Fixed marker text used to build completions from conversation turns.
_TOOL_CALL = "<|start|>assistant<|channel|>commentary to=functions>search({})<|call|>commentary<|end|>"


def completions(conversations: DataFrame) -> DataFrame:
    """Marked-up completions: each assistant turn with the user turn before it as
    its analysis; a tool call in every 5th conversation; every 7th cut off by 15
    characters. ``completion_id = conv_id * 100 + turn``.

    The self-join is an equi-join on (conv_id, turn) — the pair, not the
    conversation alone, so one long conversation does not land in one task.
    """
    a = conversations.where(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("a_text"))
    u = conversations.select(
        F.col("conv_id").alias("u_conv"), (F.col("turn") + 1).alias("u_next"), F.col("text").alias("u_text")
    )
    j = a.join(u, (a.conv_id == u.u_conv) & (a.turn == u.u_next))
    full = F.concat(
        F.lit("<|channel|>analysis<|message|>"),
        F.col("u_text"),
        F.lit("<|end|>"),
        F.when(F.col("conv_id") % 5 == 0, F.lit(_TOOL_CALL)).otherwise(F.lit("")),
        F.lit("<|start|>assistant<|channel|>final<|message|>"),
        F.col("a_text"),
        F.lit("<|return|>"),
    )
    text = F.when(F.col("conv_id") % 7 == 0, F.substring(full, F.lit(1), F.length(full) - 15)).otherwise(full)
    return j.select((F.col("conv_id") * 100 + F.col("turn")).alias("completion_id"), text.alias("text"))


def completion_chunks(completions_df: DataFrame) -> DataFrame:
    """Completions cut into pieces of ``1 + id % 97`` characters, ``is_last`` on the
    last one: ``completion_id, seq (0-based), chunk, is_last``.

    The pieces come from one linear regex pass (``.{1,w}`` repeated) rather than
    a substring per piece, which would rescan the text from its start each time.
    An empty text is a single empty piece so that its stream still ends.
    """
    width = (F.col("completion_id") % 97 + 1).cast("string")
    pieces = F.regexp_extract_all(F.col("text"), F.concat(F.lit("(?s).{1,"), width, F.lit("}")), 0)
    arr = F.when(F.length("text") == 0, F.array(F.lit(""))).otherwise(pieces)
    return (
        completions_df.select("completion_id", arr.alias("_p"))
        .select("completion_id", F.size("_p").alias("_n"), F.posexplode_outer("_p").alias("seq", "chunk"))
        .where(F.col("seq").isNotNull())
        .select(
            "completion_id",
            F.col("seq").cast("int").alias("seq"),
            "chunk",
            (F.col("seq") == F.col("_n") - 1).alias("is_last"),
        )
    )


def chat_inputs(conversations: DataFrame) -> DataFrame:
    """Chat input rows from conversations: every user turn as ``user_text`` with the
    conversation's first system turn (if any) as ``developer``; ``id = conv_id * 100 + turn``.

    The system side is reduced to one row per conversation by a partial
    aggregate before it is joined, so the join has at most one match per turn.
    """
    system = (
        conversations.where(F.col("role") == "system")
        .groupBy("conv_id")
        .agg(F.min_by("text", "turn").alias("developer"))
    )
    users = conversations.where(F.col("role") == "user").select(
        "conv_id", (F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.col("text").alias("user_text")
    )
    return users.join(system, "conv_id", "left").select("id", "developer", "user_text")


def sharegpt_conversations(conversations: DataFrame) -> DataFrame:
    """Turns as ShareGPT-like ``id, conversations: array<struct<from,value>>``."""
    from quire.operators.messages import to_sharegpt, turns_to_messages

    msgs = turns_to_messages(conversations).withColumnRenamed("conv_id", "id")
    return to_sharegpt(msgs)
