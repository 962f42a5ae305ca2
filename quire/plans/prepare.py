"""Preparation flows: files or conversations → one rendered ``text`` per sample.

Both flows are single narrow stages up to rendering (filters, chunking, message
building and rendering are row-local expressions); only optional caps and the
turns→conversation grouping shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.chunk import DEFAULT_MAX_CHARS
from quire.functions.decode import decode_utf8_lenient
from quire.operators.files import DEFAULT_MAX_FILE_BYTES, chunk_files, select_source_files
from quire.operators.messages import MAX_CONVERSATION_BYTES, file_messages, standardize_roles, turns_to_messages
from quire.functions.text import SOURCE_EXTENSIONS
from quire.operators.select import first_groups, first_rows, first_rows_exact, first_rows_per_group
from quire.operators.template import DEFAULT_TEMPLATE, ChatTemplate, render_messages

SAMPLE_KEYS = ["repo", "path", "chunk_idx"]


def file_samples(
    files: DataFrame,
    *,
    max_file_bytes: int = DEFAULT_MAX_FILE_BYTES,
    max_chars: int = DEFAULT_MAX_CHARS,
    max_samples: int | None = None,
    cap_per_repo: bool = True,
    file_order: tuple[str, ...] = ("path",),
) -> DataFrame:
    """Files (``repo, path, size`` and ``text`` or binary ``content``) → message samples
    ``repo, path, chunk_idx, messages``.

    With ``max_samples`` the first N samples in (``file_order``, repo, path, chunk_idx)
    order are kept, per repo by default (each source-tree run covers one repo).
    """
    order = list(file_order) + [c for c in ("repo", "path") if c not in file_order]
    kept = select_source_files(files, max_file_bytes)
    body = "text" if "text" in kept.columns else "content"
    if max_samples is not None:
        kept = _first_files(kept, max_samples, cap_per_repo, order)
    if body == "content":  # decode only what survived the filters (and the first-N choice)
        kept = kept.withColumn("text", decode_utf8_lenient(F.col("content"))).drop("content")
    chunks = chunk_files(kept.select("repo", "path", "text"), "text", max_chars, keys=["repo", "path"])
    samples = file_messages(chunks, keys=SAMPLE_KEYS)
    if max_samples is not None:
        samples = (
            first_rows_per_group(samples, "repo", order + ["chunk_idx"], max_samples)
            if cap_per_repo
            else first_rows(samples, order + ["chunk_idx"], max_samples)
        )
    return samples


def _first_files(kept: DataFrame, n: int, per_repo: bool, order: list[str]) -> DataFrame:
    """Early stop: every kept file yields at least one sample, so the first ``n``
    samples come from the first ``n`` files. They are chosen on path and size alone
    (the size filter says that a body is there) and joined back, so only their
    bodies are read, decoded and chunked; the exact cap on samples follows."""
    keys = kept.select("repo", "path")
    first = first_rows_per_group(keys, "repo", order, n) if per_repo else first_rows(keys, order, n)
    body = "text" if "text" in kept.columns else "content"
    chosen = kept.join(first, ["repo", "path"], "left_semi")
    missing = F.raise_error(F.concat(F.lit("a file with a size has no body: "), F.col("path"))).cast(kept.schema[body].dataType)
    return chosen.withColumn(body, F.coalesce(F.col(body), missing))


def training_text(
    files: DataFrame,
    *,
    max_file_bytes: int = DEFAULT_MAX_FILE_BYTES,
    max_chars: int = DEFAULT_MAX_CHARS,
    max_samples: int | None = None,
    template: ChatTemplate = DEFAULT_TEMPLATE,
) -> DataFrame:
    """Source-tree flow: ``repo, path, chunk_idx, text``."""
    samples = file_samples(files, max_file_bytes=max_file_bytes, max_chars=max_chars, max_samples=max_samples)
    return render_messages(samples, template=template, keep=SAMPLE_KEYS)


def conversation_training_text(
    turns: DataFrame,
    *,
    max_samples: int | None = None,
    template: ChatTemplate = DEFAULT_TEMPLATE,
    key: str = "conv_id",
    max_bytes: int | None = MAX_CONVERSATION_BYTES,
    on_oversize: str = "error",
) -> DataFrame:
    """Conversation flow on flat turns: cap (first N conversations) → messages →
    role standardisation → render: ``conv_id, text``. Conversations above ``max_bytes`` fail by name or are skipped."""
    capped = first_groups(turns, key, max_samples)
    msgs = turns_to_messages(capped, key=key, max_bytes=max_bytes, on_oversize=on_oversize)
    std = standardize_roles(msgs, "messages", from_field="role", value_field="content")
    return render_messages(std, template=template, keep=[key])


def sharegpt_training_text(
    df: DataFrame,
    *,
    key: str | list[str] | None = "id",
    conv_col: str = "conversations",
    max_samples: int | None = None,
    template: ChatTemplate = DEFAULT_TEMPLATE,
) -> DataFrame:
    """Nested ShareGPT rows (one conversation per row) → ``key, text``.

    The cap keeps exactly the first N rows, in key order and then stored order
    (stored order alone without a key), before any conversation is standardised.
    """
    keep = _keys(key)
    capped = first_rows_exact(df, keep, max_samples)
    return render_messages(standardize_roles(capped, conv_col), template=template, keep=keep)


def _keys(key: str | list[str] | None) -> list[str]:
    return [] if key is None else [key] if isinstance(key, str) else list(key)


def messages_training_text(
    df: DataFrame,
    *,
    key: str | list[str] | None = "id",
    messages_col: str = "messages",
    max_samples: int | None = None,
    template: ChatTemplate = DEFAULT_TEMPLATE,
) -> DataFrame:
    """Rows that already carry ``messages`` (role, content and optionally
    ``thinking``) → ``key, text``; capped like the nested flow."""
    keep = _keys(key)
    return render_messages(first_rows_exact(df, keep, max_samples), messages_col, template=template, keep=keep)


def tree_samples(
    spark,
    root: str,
    repo: str | None = None,
    *,
    max_file_bytes: int = DEFAULT_MAX_FILE_BYTES,
    max_chars: int = DEFAULT_MAX_CHARS,
    max_samples: int | None = None,
    num_partitions: int | None = None,
    skipped: SkipCounts | None = None,
) -> DataFrame:
    """Message samples of one source tree: ``repo, path, chunk_idx, messages``.

    The tree is walked once, into the shared checkpoint folder. Name and size filters
    run on that listing, before any content is read. With ``max_samples`` only the
    first files in path order are read: every readable kept file yields at least one
    sample, so N files suffice unless some cannot be read; then further files are read
    in rounds until N samples exist or the tree is exhausted (only counts reach the
    driver). ``skipped`` counts what could not be listed or read.
    """
    from quire.session import checkpoint_dir
    from quire.sources.tree import list_tree, listed, read_contents, readable

    checkpoint_dir(spark)  # the cluster's shared folder (a temporary one only for local tests)
    skipped = skipped if skipped is not None else SkipCounts()
    walked = list_tree(spark, root, repo, extensions=tuple(f".{e}" for e in SOURCE_EXTENSIONS), max_bytes=max_file_bytes).checkpoint(eager=True)
    skipped.unlisted += walked.where(~listed()).count()
    listing = select_source_files(walked.where(listed()), max_file_bytes)

    def samples_of(files_listing: DataFrame) -> DataFrame:
        files, seen = readable(read_contents(files_listing, root, num_partitions))
        skipped.reads.append(seen)
        chunks = chunk_files(files.select("repo", "path", "text"), "text", max_chars, keys=["repo", "path"])
        return file_messages(chunks, keys=SAMPLE_KEYS)

    if max_samples is None:
        return samples_of(listing)
    if max_samples <= 0:
        raise ValueError(f"max_samples must be positive or None, got {max_samples}")

    rounds: list[DataFrame] = []
    have, after = 0, None
    while have < max_samples:
        todo = listing if after is None else listing.where(F.col("path") > F.lit(after))
        batch = todo.orderBy("path").limit(max_samples - have).select("repo", "path", "size")
        last = batch.agg(F.max("path").alias("last"), F.count(F.lit(1)).alias("n")).first()
        if not last or last["n"] == 0:
            break
        # at most n samples per round: checkpointed to the shared folder so the
        # files are read once, and the count below does not recompute them
        part = samples_of(batch).checkpoint(eager=True)
        rounds.append(part)
        have += part.count()
        after = last["last"]
    if not rounds:
        return samples_of(listing.limit(0))
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return out.orderBy("path", "chunk_idx").limit(max_samples)


@dataclass
class SkipCounts:
    """Folders and files that could not be listed, and files that could not be read."""

    unlisted: int = 0
    reads: list = field(default_factory=list)

    @property
    def unread(self) -> int:
        """Known once the samples have been computed."""
        return sum(int(o.get["unreadable"]) for o in self.reads)


def tree_training_text(spark, root: str, repo: str | None = None, *, template: ChatTemplate = DEFAULT_TEMPLATE, **kw) -> DataFrame:
    """Source-tree flow straight from a directory: ``repo, path, chunk_idx, text``."""
    return render_messages(tree_samples(spark, root, repo, **kw), template=template, keep=SAMPLE_KEYS)
