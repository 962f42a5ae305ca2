"""Training plan: the rows, order and batches a bounded training run consumes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.epochs import steps_of
from quire.operators.shaping import (
    DEFAULT_BATCH_SIZE,
    DEFAULT_GRAD_ACCUM,
    DEFAULT_MAX_STEPS,
    DEFAULT_SEED,
    training_batches,
)


def sample_id(df: DataFrame) -> DataFrame:
    """A stable string id per sample: ``repo:path:chunk_idx`` for file samples, the conversation
    id for turns, the stored position (with the row's id, if it has one) for nested rows.

    Different keys have different ids: a colon in a path (or file) is written ``\\:``, a backslash twice, a null ``\\N``."""
    part = lambda c, pattern: F.coalesce(F.regexp_replace(F.col(c).cast("string"), pattern, r"\\$0"), F.lit("\\N"))
    if {"repo", "path", "chunk_idx"} <= set(df.columns):
        sid = F.concat(part("repo", r"\\"), F.lit(":"), part("path", r"[\\:]"), F.lit(":"), part("chunk_idx", r"\\"))
    elif "conv_id" in df.columns:
        sid = F.col("conv_id").cast("string")
    elif {"src_file", "src_row"} <= set(df.columns):
        own = [part("id", r"\\"), F.lit(":")] if "id" in df.columns else []
        sid = F.concat(*own, part("src_file", r"[\\:]"), F.lit(":"), part("src_row", r"\\"))
    elif "id" in df.columns:
        sid = F.col("id").cast("string")
    else:
        raise ValueError(f"no key columns to build a sample id from: {df.columns}")
    return df.withColumn("sample_id", sid)


def training_plan(
    samples: DataFrame,
    *,
    max_steps: int = DEFAULT_MAX_STEPS,
    batch_size: int = DEFAULT_BATCH_SIZE,
    grad_accum: int = DEFAULT_GRAD_ACCUM,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """``sample_id, epoch, step, micro, text`` for the whole budget."""
    with_id = sample_id(samples).select("sample_id", "text")
    return training_batches(
        with_id, "sample_id", max_steps=max_steps, batch_size=batch_size, grad_accum=grad_accum, seed=seed
    ).select("sample_id", "epoch", "step", "micro", "text")


def resumed_plan(
    samples: DataFrame,
    from_step: int,
    to_step: int,
    *,
    batch_size: int = DEFAULT_BATCH_SIZE,
    grad_accum: int = DEFAULT_GRAD_ACCUM,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """``sample_id, epoch, step, micro, text`` of some steps of an order that is addressed by step, so that a run resumes
    anywhere without the steps before. ``samples`` is a prepared table as it is stored (``load_prepared``)."""
    rows = steps_of(samples, from_step, to_step, batch_size=batch_size, grad_accum=grad_accum, seed=seed)
    return sample_id(rows).select("sample_id", "epoch", "step", "micro", "text")
