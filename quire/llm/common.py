"""Small helpers the operators share: column selection, tables in the shared folder, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quire.session import checkpoint_dir, ship_package

#: What Python workers take at a time: bytes of text, and rows.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 500


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the columns an operator reads, under its own names, so extra columns never clash."""
    return df.select(*(col(src).alias(dst) for dst, src in names.items()))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage at a compressed columnar table that survives lost executors.
    The table stays until ``dropped`` or until its folder ``quire-...`` is removed with the
    session's checkpoint folder: results are lazy, so only the caller knows when one was read.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/quire-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._saved_at = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Removes tables that ``saved`` returned, once nothing reads them any more.

    Spark lets go of the shuffles and broadcasts of finished jobs when the driver collects its garbage.
    Chains of small jobs leave much of both long before its heap is full, so it is asked to here.
    """
    for df in tables:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._saved_at)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
    if tables:
        tables[0].sparkSession._jvm.System.gc()


def by_bytes(batch, column: str, limit: int = SLICE_BYTES):
    """Slices of an Arrow batch with at most ``limit`` bytes of a text column each, or one row."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = total = 0
    for k, n in enumerate(size.tolist()):
        if k > at and (total + n > limit or k - at >= SLICE_ROWS):
            yield batch.slice(at, k - at)
            at, total = k, 0
        total += n
    if at < batch.num_rows:
        yield batch.slice(at)


def free_names(df: DataFrame, *names: str) -> None:
    """Fails where columns an operator adds are there already (names compare as Spark resolves them)."""
    same = df.sparkSession.conf.get("spark.sql.caseSensitive") != "true"
    have = {c.lower() if same else c for c in df.columns}
    if taken := [n for n in names if (n.lower() if same else n) in have]:
        raise ValueError(f"the output columns {taken} are taken; choose another prefix")


def give_back() -> None:
    """Returns to the system what a worker's allocators hold unused, as workers live on between tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with the package shipped, for columns of any name (dots, spaces); unused memory goes back after each partition."""
    names = df.columns

    def named(batches):
        try:
            yield from run(b.rename_columns(names) for b in batches)
        finally:
            give_back()

    return ready(df).toDF(*(f"c{k}" for k in range(len(names)))).mapInArrow(named, schema)


def ready(df: DataFrame) -> DataFrame:
    """Ship the package to the Python workers; returns ``df``."""
    ship_package(df.sparkSession)
    return df


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of undirected links ``(a, b)``: rows ``(id, component, n)``, the least id reachable and how many there are.

    Contraction: every vertex points to the least of itself and its neighbours, by a hash of
    their ids, and links are redrawn between what their ends point to. A star is one vertex after
    two rounds, a chain shrinks to the places of its hashes' minima, so rounds are few; each is
    one grouped minimum and two equi-joins in a single job that writes links and pointers to the
    shared folder and counts, as it writes, the links that are left. A hub (a third of all links on one
    vertex) is combined before it is shuffled. When no link is left, the rounds' pointers are
    followed and each group takes its least id; what the rounds wrote is removed.
    Vertices without a link are not returned; loops and repeated links are allowed.
    """
    ends = lambda a, b: [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
    first = e = saved(edges.where(F.col("a") != F.col("b")).select(*ends("a", "b")).distinct(), name)
    rounds = []
    by = lambda c: F.struct(F.xxhash64(F.lit(7), c).alias("h"), F.col(c).alias("p"))
    while True:
        both = e.select(F.col("a").alias("u"), by("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), by("a").alias("v")))
        to = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("v", by("u")).getField("p").alias("p"))
        left, right = to.select(F.col("u").alias("a"), F.col("p").alias("pa")), to.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        apart = Observation()
        x = saved(e.join(left, "a").join(right, "b").select("a", "b", "pa", "pb").observe(
            apart, F.count_if(F.col("pa") != F.col("pb")).alias("n")), name)
        rounds.append(x)
        if not apart.get["n"]:
            break
        e = x.where("pa != pb").select(*ends("pa", "pb")).distinct()
    label = None
    for x in rounds:
        # a vertex has one pointer, on each of its links
        to = x.select(F.col("a").alias("u"), F.col("pa").alias("q")).unionByName(
            x.select(F.col("b").alias("u"), F.col("pb").alias("q"))).groupBy("u").agg(F.min("q").alias("q"))
        label = to.toDF("id", "p") if label is None else label.join(
            to.withColumnRenamed("u", "p"), "p", "left").select("id", F.coalesce("q", "p").alias("p"))
    label = saved(label, name)
    dropped(first, *rounds)
    low = label.groupBy("p").agg(F.min("id").alias("component"), F.count("*").alias("n"))
    return label.join(low, "p").select("id", "component", "n")
