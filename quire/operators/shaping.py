"""Training-set shaping: seeded budget, step / micro-batch assignment, length flags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import checkpoint_dir

# ---------------------------------------------------------------------------
# Training defaults.
DEFAULT_SEED = 3407
DEFAULT_MAX_STEPS = 30
DEFAULT_BATCH_SIZE = 1
DEFAULT_GRAD_ACCUM = 4
DEFAULT_MAX_SEQ_LENGTH = 4096
CHARS_PER_TOKEN = 4
# ---------------------------------------------------------------------------
# Order keys are numbered within buckets of their first four hexadecimal digits.
BUCKET_DIGITS = 4


def order_key(seed: int | Column, sample_id: Column, epoch: Column | None = None) -> Column:
    """Reproducible pseudo-random order: ``md5("{seed+epoch}:{id}")``, any engine can match it."""
    s = seed if isinstance(seed, Column) else F.lit(int(seed))
    if epoch is not None:
        s = s + epoch
    return F.md5(F.concat(s.cast("string"), F.lit(":"), sample_id.cast("string")))


def training_budget(
    df: DataFrame,
    id_col: str,
    *,
    max_steps: int = DEFAULT_MAX_STEPS,
    batch_size: int = DEFAULT_BATCH_SIZE,
    grad_accum: int = DEFAULT_GRAD_ACCUM,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The ``max_steps * batch * accum`` samples a run consumes: the first in seeded order
    (one pass; see ``training_batches`` for re-use across epochs). Chosen on ids alone."""
    budget = int(max_steps) * int(batch_size) * int(grad_accum)
    picked = _numbered(df.select(id_col).withColumn("epoch", F.lit(0)), id_col, seed, budget)
    return df.join(picked.where(F.col("_rn") < budget).select(id_col), id_col, "left_semi")


def _numbered(keys: DataFrame, id_col: str, seed: int, budget: int) -> DataFrame:
    """``id, epoch, _rn``: the place of each key in the order (epoch, order key, id), for places
    that can lie below ``budget``.

    Keys are hashes, so their leading digits cut each epoch into even buckets: a bucket's first
    place follows from the buckets' counts (at most 16^BUCKET_DIGITS rows an epoch), and places
    within a bucket are one window each. No task sees more than a bucket, whatever the budget;
    buckets that start beyond it never reach the window.
    """
    if budget <= 0:
        raise ValueError("training budget must be positive")
    k = keys.withColumn("_k", order_key(seed, F.col(id_col), F.col("epoch"))).withColumn("_b", F.left("_k", F.lit(BUCKET_DIGITS)))
    counts = k.groupBy("epoch", "_b").agg(F.count(F.lit(1)).alias("_n"))
    per_epoch = counts.groupBy("epoch").agg(F.sum("_n").alias("_e"))
    before = F.sum("_n").over(Window.partitionBy("epoch").orderBy("_b")) - F.col("_n")
    base = F.col("epoch") * F.col("_e")  # every epoch holds the same rows
    first = counts.join(per_epoch, "epoch").select("epoch", "_b", (base + before).alias("_first")).where(F.col("_first") < budget)
    w = Window.partitionBy("epoch", "_b").orderBy("_k", id_col)
    return k.join(first, ["epoch", "_b"]).select(id_col, "epoch", (F.col("_first") + F.row_number().over(w) - 1).alias("_rn"))


def training_batches(
    df: DataFrame,
    id_col: str,
    *,
    max_steps: int = DEFAULT_MAX_STEPS,
    batch_size: int = DEFAULT_BATCH_SIZE,
    grad_accum: int = DEFAULT_GRAD_ACCUM,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Budget rows with ``epoch``, ``step`` (1-based) and ``micro`` (1..accum).

    ``id_col`` tells rows apart; a row without one fails the task that meets it. A table smaller than the budget is passed over again: the
    epoch count ``ceil(budget / min(count, budget))`` is a scalar subquery, each id is expanded
    by a generator over ``sequence(0, epochs-1)`` (a single element for any table at least as
    large as the budget), and epoch ``e`` is ordered with seed ``seed+e``. Rows are chosen and
    numbered on their ids alone, which are written to the shared checkpoint folder first; all other
    columns are joined to the chosen ids at the end.
    """
    per_step = int(batch_size) * int(grad_accum)
    budget = int(max_steps) * per_step
    if budget <= 0:
        raise ValueError("training budget must be positive")
    # Only min(count, budget) matters: counting a limited plan lets every task stop early.
    told = F.coalesce(F.col(id_col), F.raise_error(F.lit(f"a sample has no {id_col}")).cast(df.schema[id_col].dataType))
    # the ids are derived once (decoding and chunking may stand above them) and counted, placed and numbered from there
    checkpoint_dir(df.sparkSession)
    ids = df.select(told.alias(id_col)).checkpoint(eager=True)
    n = ids.limit(budget).select(F.count(F.lit(1)).alias("n")).scalar()
    epochs = F.greatest(F.lit(1), F.ceil(F.lit(budget) / n).cast("int"))
    expanded = ids.withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
    picked = _numbered(expanded, id_col, seed, budget).where(F.col("_rn") < budget)
    numbered = picked.select(
        id_col,
        F.col("epoch").cast("bigint").alias("epoch"),
        (F.floor(F.col("_rn") / per_step) + 1).cast("bigint").alias("step"),
        (F.floor(F.col("_rn") / int(batch_size)) % int(grad_accum) + 1).cast("bigint").alias("micro"),
    )
    if df.columns == [id_col]:
        return numbered
    return df.join(numbered, id_col)


def approx_tokens(text: Column) -> Column:
    """Default token-count proxy: ``ceil(characters / 4)``."""
    return F.ceil(F.length(text) / F.lit(CHARS_PER_TOKEN)).cast("bigint")


def flag_over_length(
    df: DataFrame,
    text_col: str = "text",
    *,
    max_seq_length: int = DEFAULT_MAX_SEQ_LENGTH,
    count_tokens: Callable[[Column], Column] = approx_tokens,
) -> DataFrame:
    """Adds ``n_tokens`` and ``over_limit`` (n_tokens > max_seq_length)."""
    n = count_tokens(F.col(text_col)).cast("bigint")
    return df.withColumn("n_tokens", n).withColumn("over_limit", F.col("n_tokens") > int(max_seq_length))


def length_summary(df: DataFrame, text_col: str = "text", count_tokens: Callable[[Column], Column] = approx_tokens) -> DataFrame:
    """Approximate token-length quantiles (p50, p90, p99, max) in one aggregate."""
    n = count_tokens(F.col(text_col))
    q = F.percentile_approx(n, [0.5, 0.9, 0.99])
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("samples"),
        q.alias("_q"),
        F.max(n).cast("bigint").alias("max_tokens"),
    ).select(
        "samples",
        *[F.col("_q")[i].cast("bigint").alias(name) for i, name in enumerate(("p50", "p90", "p99"))],
        "max_tokens",
    )
