"""Streaming preparation: arriving conversation rows, or the added and changed files of a source tree → rendered training text.

Every step of the conversation flow is per row (standardise roles, render), so
the stream is stateless: a file-source ``readStream`` with an explicit schema,
the same DataFrame operators as the batch flow, and a Parquet ``writeStream``
whose checkpoint lives under the shared checkpoint folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.chunk import DEFAULT_MAX_CHARS
from quire.operators.files import DEFAULT_MAX_FILE_BYTES, chunk_files, select_source_files
from quire.operators.messages import file_messages, standardize_roles
from quire.operators.template import DEFAULT_TEMPLATE, ChatTemplate, render_messages
from quire.session import stream_checkpoint
from quire.sources.tree import read_contents, stream_tree

SHAREGPT_SCHEMA = "id bigint, conversations array<struct<from:string,value:string>>"
MESSAGES_SCHEMA = "id bigint, messages array<struct<role:string,content:string,thinking:string>>"


def conversation_text_stream(
    spark: SparkSession,
    source_dir: str,
    *,
    schema: str = SHAREGPT_SCHEMA,
    fmt: str = "parquet",
    template: ChatTemplate = DEFAULT_TEMPLATE,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.load(source_dir)
    if "messages" in rows.columns:  # already role/content (optionally thinking)
        return render_messages(rows, template=template, keep=["id"])
    return render_messages(standardize_roles(rows), template=template, keep=["id"])


def tree_text_stream(
    spark: SparkSession,
    root: str,
    repo: str | None = None,
    *,
    max_file_bytes: int = DEFAULT_MAX_FILE_BYTES,
    max_chars: int = DEFAULT_MAX_CHARS,
    template: ChatTemplate = DEFAULT_TEMPLATE,
    num_partitions: int | None = None,
    settle_seconds: float = 5.0,
) -> DataFrame:
    """The source-tree flow over files as they are added or changed: ``repo, path, chunk_idx, text`` of each such file, all its
    pieces in one batch. A changed file's new pieces come after its old ones; which are its latest is told by the batch."""
    n = num_partitions or spark.sparkContext.defaultParallelism
    listing = select_source_files(stream_tree(spark, root, repo, n, settle_seconds), max_file_bytes)
    files = read_contents(listing, root, n).where(F.col("text").isNotNull())
    chunks = chunk_files(files.select("repo", "path", "text"), "text", max_chars, keys=["repo", "path"])
    keys = ["repo", "path", "chunk_idx"]
    return render_messages(file_messages(chunks, keys=keys), template=template, keep=keys)


def start_tree_stream(
    spark: SparkSession, root: str, out_dir: str, repo: str | None = None, *, name: str | None = None, available_now: bool = True, **kw
) -> StreamingQuery:
    """Start the tree's stream into ``out_dir``, a folder ``batch=<id>`` per micro-batch that a repeated batch replaces
    whole; with ``available_now`` it prepares what has changed since the last run and stops."""
    if name is None:
        name = "tree-" + hashlib.sha256(f"{root.rstrip('/')}\n{out_dir.rstrip('/')}".encode()).hexdigest()[:32]

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={number}")

    writer = tree_text_stream(spark, root, repo, **kw).writeStream.foreachBatch(put).option("checkpointLocation", stream_checkpoint(spark, name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def latest_tree_text(spark: SparkSession, out_dir: str) -> DataFrame:
    """The text of each file's latest batch, without the pieces of its earlier contents."""
    rows = spark.read.option("basePath", out_dir).parquet(out_dir)
    last = rows.groupBy("repo", "path").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["repo", "path", "batch"], "left_semi").select("repo", "path", "chunk_idx", "text")


def start_prepare_stream(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    *,
    name: str | None = None,
    available_now: bool = True,
    **kw,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops.

    The checkpoint belongs to the pair of source and output folder unless ``name`` names
    another, so a second output of the same source starts from the beginning.
    """
    if name is None:
        name = "prepare-" + hashlib.sha256(f"{source_dir.rstrip('/')}\n{out_dir.rstrip('/')}".encode()).hexdigest()[:32]
    df = conversation_text_stream(spark, source_dir, **kw)
    writer = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", stream_checkpoint(spark, name))
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(out_dir)
