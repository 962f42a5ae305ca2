"""A training order that is addressed by step: which row a slot takes is computed, not looked up.

Rows are numbered densely from 0 (``dense_rows``: a file's rows follow each other, files follow
by name). Each epoch is a keyed permutation of these numbers, so the rows of any steps of any epoch
come from arithmetic alone: no sort, no count over ids and no table of the order, and a run
resumes at a step by asking for the steps from there on.

The permutation is swap-or-not: in each round a number ``x`` has a partner ``(K - x) mod n``, the
same for both of the pair, and a bit of a hash of the greater of the two says whether they swap.
Every round is its own inverse, so the permutation is exact for every ``n`` without walking out of
range, and the same rounds backwards lead from a row to its slot (``slot_of``). All of it is column
expressions over md5, which any engine can repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators.shaping import DEFAULT_BATCH_SIZE, DEFAULT_GRAD_ACCUM, DEFAULT_SEED

# Rounds of the permutation. Each brings the order nearer to an even draw of all orders.
ROUNDS = 24
# Hexadecimal digits of a round's key: below 2^60, so that the number fits.
KEY_DIGITS = 15
_ODD = "13579bdf"


def _key(seed: int, epoch: Column) -> Column:
    return F.concat(F.lit(f"{int(seed)}:"), epoch.cast("string"), F.lit(":"))


def _round(key: Column, n: Column, x: Column, r: Column) -> Column:
    k = F.conv(F.substring(F.md5(F.concat(key, r.cast("string"))), 1, KEY_DIGITS), 16, 10).cast("bigint")
    y = F.pmod(k % n - x, n)
    bit = F.substring(F.md5(F.concat(key, r.cast("string"), F.lit(":"), F.greatest(x, y).cast("string"))), 1, 1)
    return F.when(F.instr(F.lit(_ODD), bit) > 0, y).otherwise(x)


def row_of(slot: Column, n: Column, seed: int, epoch: Column, rounds: int = ROUNDS) -> Column:
    """The row that a slot of an epoch takes; slots and rows lie in ``[0, n)``."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), slot.cast("bigint"), lambda x, r: _round(_key(seed, epoch), n, x, r))


def slot_of(row: Column, n: Column, seed: int, epoch: Column, rounds: int = ROUNDS) -> Column:
    """The slot of an epoch that takes a row: the rounds backwards."""
    return F.aggregate(F.sequence(F.lit(rounds - 1), F.lit(0)), row.cast("bigint"), lambda x, r: _round(_key(seed, epoch), n, x, r))


def rows_of_steps(
    spark: SparkSession,
    n: int,
    from_step: int,
    to_step: int,
    *,
    batch_size: int = DEFAULT_BATCH_SIZE,
    grad_accum: int = DEFAULT_GRAD_ACCUM,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """``position, epoch, step, micro, row`` of the steps ``from_step`` to ``to_step`` (from 1, both included) of a table of ``n`` rows.

    Made by ``range`` in as many tasks as the session has partitions: the cost is that of the asked steps, wherever they lie.
    """
    per_step = int(batch_size) * int(grad_accum)
    if n <= 0 or per_step <= 0 or not 1 <= from_step <= to_step:
        raise ValueError("a training order needs rows, a positive batch and steps from 1 on")
    p, rows = F.col("id"), F.lit(int(n)).cast("bigint")
    epoch = F.floor(p / rows).cast("bigint")
    return spark.range((from_step - 1) * per_step, to_step * per_step).select(
        p.alias("position"),
        epoch.alias("epoch"),
        (F.floor(p / per_step) + 1).cast("bigint").alias("step"),
        (F.floor(p / int(batch_size)) % int(grad_accum) + 1).cast("bigint").alias("micro"),
        row_of(F.pmod(p, rows), rows, seed, epoch).alias("row"),
    )


def dense_rows(table: DataFrame, row_col: str = "row") -> DataFrame:
    """A whole Parquet table with its rows numbered from 0 in stored order: each file's first number is the rows of the
    files before it, counted from the files' footers. Rows that a filter drops would leave gaps: number first."""
    file, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    counts = table.groupBy(file.alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    # one row a file; numbered in one window, as the listing of the files is one list too
    first = counts.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_first"))
    placed = table.select("*", file.alias("_file"), at.alias("_at"))
    return placed.join(first, "_file").select(*(F.col(f"`{c}`") for c in table.columns), (F.col("_first") + F.col("_at")).alias(row_col))


def steps_of(
    table: DataFrame,
    from_step: int,
    to_step: int,
    *,
    batch_size: int = DEFAULT_BATCH_SIZE,
    grad_accum: int = DEFAULT_GRAD_ACCUM,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The rows of a Parquet table that the given steps take, with ``position, epoch, step, micro``; a table smaller than the
    steps is passed over again. The join is an equi-join on the row number, which Spark sizes: a few steps are
    broadcast and filter the scan, a whole epoch meets the table by a shuffle."""
    n = table.count()
    wanted = rows_of_steps(table.sparkSession, n, from_step, to_step, batch_size=batch_size, grad_accum=grad_accum, seed=seed)
    return dense_rows(table, "_row").join(wanted, F.col("_row") == F.col("row")).drop("_row", "row")
