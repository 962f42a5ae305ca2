"""Source-file filters and chunking: ``DataFrame -> DataFrame`` operators.

Input rows describe files: ``repo, path, size`` (+ ``text`` or ``content``).
Filters are plain column predicates, so on a Parquet-backed table Catalyst
pushes the size bound into the scan; on a tree listing they run before any
content is read (see ``sources.tree``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.chunk import DEFAULT_MAX_CHARS, chunk_label, chunk_text
from quire.functions.text import has_source_extension, in_vcs_dir

DEFAULT_MAX_FILE_BYTES = 250_000


def keep_source_extensions(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Files whose last suffix is .py / .md / .markdown, case-insensitively."""
    return df.where(has_source_extension(F.col(path_col)))


def drop_vcs_paths(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Drop paths with a component equal to ``.git``."""
    return df.where(~in_vcs_dir(F.col(path_col)))


def keep_file_size(df: DataFrame, max_file_bytes: int = DEFAULT_MAX_FILE_BYTES, size_col: str = "size") -> DataFrame:
    """Keep ``0 < size <= max_file_bytes`` (bytes on disk)."""
    return df.where(F.col(size_col).between(1, int(max_file_bytes)))


def select_source_files(df: DataFrame, max_file_bytes: int = DEFAULT_MAX_FILE_BYTES, path_col: str = "path") -> DataFrame:
    """All file filters of source-tree mode, cheapest first."""
    return keep_file_size(drop_vcs_paths(keep_source_extensions(df, path_col), path_col), max_file_bytes)


def chunk_files(
    df: DataFrame,
    text_col: str = "text",
    max_chars: int = DEFAULT_MAX_CHARS,
    keys: list[str] | None = None,
) -> DataFrame:
    """One row per piece: ``keys..., chunk_idx (1-based), chunk_cnt, chunk``.

    ``posexplode`` over the piece array: a narrow generator, no window or shuffle.
    The ``_outer`` form is used on purpose: for a plain generator the optimizer
    infers a ``size(array) > 0`` filter and pushes it below the projection, which
    would run the chunking twice. Pieces are never empty for a non-null
    text, so dropping the null row of a null text afterwards is equivalent.
    """
    if max_chars <= 0:
        raise ValueError(f"max_chars must be positive, got {max_chars}")
    keys = keys if keys is not None else [c for c in df.columns if c not in (text_col, "content")]
    pieces = chunk_text(F.col(text_col), max_chars)
    return (
        df.select(*keys, pieces.alias("_pieces"))
        .select(*keys, F.size("_pieces").alias("chunk_cnt"), F.posexplode_outer("_pieces").alias("_pos", "chunk"))
        .where(F.col("_pos").isNotNull())
        .select(*keys, (F.col("_pos") + 1).alias("chunk_idx"), "chunk_cnt", "chunk")
    )


def with_chunk_label(df: DataFrame, out_col: str = "chunk_label") -> DataFrame:
    return df.withColumn(out_col, chunk_label(F.col("chunk_idx"), F.col("chunk_cnt")))
