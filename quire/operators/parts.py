"""Reports that grow with their corpus: stored parts, added for what arrives and merged without a rescan.

``add_parts`` stores the parts of one arrival (per-file rows of the corpus report) as a folder of its own, named by
the arrival, so a repeated run replaces its own parts and no others. ``merged_parts`` takes the
latest row of each file; ``corpus_parts`` of a file says all that the report needs of it, so the report
after any arrivals equals one run over all files as they are now. ``length_sketches`` stores one quantile sketch per group,
which merge to the quantiles of any union of groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.shaping import approx_tokens

ARRIVAL = "arrival"
# Of a file that is gone: no reason of the report, so the file counts nowhere.
GONE = "gone"
# Size of the quantile sketches: with k items a level a rank is off by less than RANK_ERROR of all rows
# (the 99 % bound of single ranks published for this sketch at this k).
SKETCH_K = 1000
RANK_ERROR = 0.003


def add_parts(parts: DataFrame, table_dir: str, arrival: int) -> None:
    """Store the parts of one arrival (a number that rises from arrival to arrival) under ``table_dir``.

    The folder is written whole or, by a later run of the same arrival, replaced whole."""
    if arrival < 0:
        raise ValueError("arrivals are numbered from 0")
    parts.write.mode("overwrite").parquet(f"{table_dir.rstrip('/')}/{ARRIVAL}={int(arrival)}")


def gone_parts(files: DataFrame) -> DataFrame:
    """Parts that say of ``repo, path`` rows that these files are no longer there."""
    return files.select("repo", "path", F.lit(GONE).alias("reason"), F.lit(0).cast("bigint").alias("pieces"), F.lit(0).cast("bigint").alias("chars"))


def merged_parts(spark: SparkSession, table_dir: str) -> DataFrame:
    """The latest part of each file over all arrivals; a file that is gone has none.

    One aggregate by file over small rows (no texts), combined per task first; a file's rows are as many as its arrivals."""
    rows = spark.read.option("basePath", table_dir).parquet(table_dir)
    columns = [c for c in rows.columns if c not in ("repo", "path", ARRIVAL)]
    last = rows.groupBy("repo", "path").agg(F.max_by(F.struct(*columns), F.col(ARRIVAL)).alias("p"))
    return last.select("repo", "path", *(F.col(f"p.{c}").alias(c) for c in columns)).where(F.col("reason") != GONE)


def compact_parts(spark: SparkSession, table_dir: str, out_dir: str, arrival: int) -> None:
    """The merged parts as one arrival of a new table, so that reports stay as fast as the number of files allows."""
    add_parts(merged_parts(spark, table_dir), out_dir, arrival)


def length_sketches(
    samples: DataFrame,
    by: list[str],
    text_col: str = "text",
    count_tokens: Callable[[Column], Column] = approx_tokens,
    k: int = SKETCH_K,
) -> DataFrame:
    """``by..., samples, max_tokens, lengths``: a quantile sketch of the token lengths of each group (a file, a source, an
    arrival), of a bounded size whatever the group's. Null texts are left out."""
    n = count_tokens(F.col(text_col)).cast("bigint")
    return samples.where(F.col(text_col).isNotNull()).select(*by, n.alias("_n")).groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("samples"),
        F.max("_n").cast("bigint").alias("max_tokens"),
        F.kll_sketch_agg_bigint("_n", F.lit(int(k))).alias("lengths"),
    )


def length_quantiles(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9, 0.99), by: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """Samples, quantiles (``p50``, ...) and maximum of all sketches together, or of each group of them: stored sketches
    merge in any order, so no sample is read again. A quantile's rank is off by less than ``RANK_ERROR`` of the samples."""
    q = F.kll_sketch_get_quantile_bigint("_all", F.array(*(F.lit(float(x)) for x in quantiles)))
    merged = sketches.groupBy(*(by or [])).agg(
        F.sum("samples").cast("bigint").alias("samples"), F.max("max_tokens").cast("bigint").alias("max_tokens"),
        F.kll_merge_agg_bigint("lengths", F.lit(int(k))).alias("_all"),
    )
    return merged.withColumn("_q", F.when(F.col("samples") > 0, q)).select(
        *(by or []), "samples", *(F.col("_q")[i].cast("bigint").alias(f"p{x * 100:g}") for i, x in enumerate(quantiles)), "max_tokens")
