"""Ordered selection, counts and the corpus report.

"First N" is always an explicit order plus ``limit`` so the planner emits
``TakeOrderedAndProject`` (per-partition top-k, then one bounded merge) rather
than a full sort; per-group caps use ``row_number() <= n``, which Spark plans as
a ``WindowGroupLimit`` that trims each partition before the shuffle. Large groups
are cut in two levels (by salt, then by group), so no task takes the first rows of
every other task of a hot group.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.chunk import DEFAULT_MAX_CHARS, chunk_count
from quire.functions.text import has_source_extension, in_vcs_dir
from quire.operators.files import DEFAULT_MAX_FILE_BYTES

# First level of a two-level first-N: this many independent tasks per group.
SALTS = 64


def _check_cap(n: int | None) -> None:
    if n is not None and n <= 0:
        raise ValueError(f"cap must be positive or None, got {n}")


def first_rows(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """First ``n`` rows in ``order`` (``None`` = all rows, unordered)."""
    _check_cap(n)
    if n is None:
        return df
    return df.orderBy(*order).limit(int(n))


def first_row(df: DataFrame, order: list[str]) -> DataFrame:
    """The first row in ``order``; an empty input gives an empty result."""
    return df.orderBy(*order).limit(1)


def _salt(cols: list[str]) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS))


def first_rows_per_group(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows per ``group`` in ``order`` (which should tell rows apart; ties are cut at will).

    Cut to ``n`` per (group, salt) first, so a group with a third of all rows is
    reduced by many tasks before its last window sees ``SALTS * n`` rows at most.
    """
    _check_cap(n)
    level = df.withColumn("_salt", _salt(order))
    for keys in ([group, "_salt"], [group]):
        w = Window.partitionBy(*keys).orderBy(*order)
        level = level.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= int(n)).drop("_rn")
    return level.drop("_salt")


def first_groups(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """All rows of the ``n`` smallest values of ``key`` (first N conversations of
    a flat turns table). ``None`` = all. Rows with a null key are in no group and
    are left out of a capped result.

    One path for keys of every type, in the JVM: each salt keeps its ``n`` smallest
    distinct keys (trimmed per partition before the exchange), the ``n`` smallest of
    those are taken, and they are joined back as a semi-join that Spark sizes.
    """
    _check_cap(n)
    if n is None:
        return df
    n = int(n)
    w = Window.partitionBy("_salt").orderBy(key)
    keys = df.where(F.col(key).isNotNull()).select(key).withColumn("_salt", _salt([key]))
    keys = keys.withColumn("_rn", F.dense_rank().over(w)).where(F.col("_rn") <= n).select(key).distinct()
    return df.join(keys.orderBy(key).limit(n), on=key, how="left_semi")


# So many (file, split) pairs come to the driver to be joined as a local table; more are joined as they are.
MAX_LOCAL_SPLITS = 10_000


def with_position(df: DataFrame) -> DataFrame:
    """``df`` with ``src_file`` and ``src_row``: a row's place in stored order.

    Parquet tables carry it (file path and row index). Of other files Spark knows the split a row is from (file
    and first byte) and reads a split's rows in order: a row's number is the split's first byte plus its place in
    the split, which rises along the file as no row is shorter than a byte. Such a table, and one that is
    not read from files, is written once to the shared checkpoint folder, which fixes the numbers of its rows.
    A table that has both columns already stays as it is.
    """
    if {"src_file", "src_row"} <= set(df.columns):
        return df
    at = F.monotonically_increasing_id()
    try:
        return df.select("*", F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.row_index").alias("src_row"))
    except AnalysisException:
        from quire.session import checkpoint_dir

        checkpoint_dir(df.sparkSession)
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("_split"), at.alias("_at"))
    except AnalysisException:
        return df.select("*", F.lit("").alias("src_file"), at.alias("src_row")).checkpoint(eager=True)
    placed = placed.checkpoint(eager=True)
    first = placed.groupBy("src_file", "_split").agg(F.min("_at").alias("_first"))
    few = first.limit(MAX_LOCAL_SPLITS + 1).collect()
    if len(few) <= MAX_LOCAL_SPLITS:
        first = df.sparkSession.createDataFrame(few, first.schema)
    row = F.col("_split") + F.col("_at") - F.col("_first")
    return placed.join(first, ["src_file", "_split"]).select(*(F.col(f"`{c}`") for c in df.columns), "src_file", row.alias("src_row"))


def first_rows_exact(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """Exactly the first ``n`` rows (all, if there are fewer), whatever their values:
    by ``order`` (nulls last), then by stored position, which also breaks ties.

    The choice is a top-k over the order and position columns alone; the rows are
    joined back by position, so whole conversations never travel through it.
    """
    _check_cap(n)
    if n is None:
        return df
    placed = with_position(df)
    by = [F.col(c).asc_nulls_last() for c in [*(c for c in order if c not in ("src_file", "src_row")), "src_file", "src_row"]]
    first = placed.orderBy(*by).limit(int(n)).select("src_file", "src_row")
    return placed.join(first, ["src_file", "src_row"], "left_semi").select(*df.columns)


def pick_split(df: DataFrame, split_col: str = "split", prefer: str = "train") -> DataFrame:
    """Rows of one split: ``prefer`` if present, else the least split name.

    The choice is a one-row global aggregate (partial per partition) joined back;
    on a split-partitioned Parquet table the join prunes partitions dynamically.
    """
    choice = df.where(F.col(split_col).isNotNull()).agg(
        F.min_by(F.col(split_col), F.struct(F.col(split_col) != F.lit(prefer), F.col(split_col))).alias("_pick")
    )
    return df.join(F.broadcast(choice), F.col(split_col) == F.col("_pick"), "left_semi")


def sample_count(df: DataFrame, out_col: str = "samples") -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(out_col))


# Why a file of a corpus is left out, by the first check that fails; "kept" passes all.
REASONS = ("vcs", "extension", "empty", "too_big", "unreadable")


def corpus_parts(
    files: DataFrame,
    max_file_bytes: int = DEFAULT_MAX_FILE_BYTES,
    max_chars: int = DEFAULT_MAX_CHARS,
    text_col: str = "text",
) -> DataFrame:
    """One row per file, ``repo, path, reason, pieces, chars``: what the report adds up. A file that has a size
    and no text is unreadable. A narrow projection; texts end here."""
    path, size = F.col("path"), F.col("size")
    # one reason per file, first failing check wins (evaluated once per row)
    reason = (
        F.when(in_vcs_dir(path), F.lit("vcs"))
        .when(~has_source_extension(path), F.lit("extension"))
        .when(size <= 0, F.lit("empty"))
        .when(size > int(max_file_bytes), F.lit("too_big"))
        .when(F.col(text_col).isNull(), F.lit("unreadable"))
        .otherwise(F.lit("kept"))
    )
    kept = F.col("reason") == "kept"
    pieces = F.when(kept, chunk_count(F.col(text_col), max_chars)).otherwise(F.lit(0))
    chars = F.when(kept, F.length(F.col(text_col))).otherwise(F.lit(0))
    return files.select("repo", "path", reason.alias("reason"), text_col).select(
        "repo", "path", "reason", pieces.cast("bigint").alias("pieces"), chars.cast("bigint").alias("chars")
    )


def report_of(parts: DataFrame) -> DataFrame:
    """The corpus report from its parts: one hash aggregate keyed by repo (partial per partition, so a repo with a
    third of all files is already reduced to one row per map task before the shuffle)."""

    def cnt(r: str):
        return F.count_if(F.col("reason") == r).cast("bigint")

    return parts.groupBy("repo").agg(
        F.count(F.lit(1)).cast("bigint").alias("files_in"),
        cnt("kept").alias("files_kept"),
        *(cnt(r).alias(f"skipped_{r}") for r in REASONS),
        F.sum("pieces").cast("bigint").alias("chunks"),
        F.sum("chars").cast("bigint").alias("characters"),
    )


def corpus_report(
    files: DataFrame,
    max_file_bytes: int = DEFAULT_MAX_FILE_BYTES,
    max_chars: int = DEFAULT_MAX_CHARS,
    text_col: str = "text",
) -> DataFrame:
    """Per repo: files seen, kept, skipped by first failing reason (``REASONS``), and the kept files' pieces and characters."""
    return report_of(corpus_parts(files, max_file_bytes, max_chars, text_col))
