"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quire") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off).

    Only for tests and the bench: it names its own checkpoint folder, which a
    cluster session never does (there the setting is given and only read).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "16g"))
    )
    builder = builder.config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="quire-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only where it is unset on a local master (tests) is a
    fresh folder made and handed to the SparkContext. Unset on a cluster is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError(
                f"{CHECKPOINT_CONF} is not set: on a cluster it must name shared storage "
                "(a machine-local folder would not survive the loss of an executor or the driver)"
            )
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quire-ckpt-"))
    return os.path.dirname(sc.getCheckpointDir().rstrip("/"))


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location for a streaming query, under the shared folder."""
    return os.path.join(checkpoint_dir(spark), "streams", name)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make this package importable by Python workers on every executor.

    Arrow UDFs, ``mapInPandas`` and stateful processors run package code in
    worker processes; ``addPyFile`` distributes a zip of the package through
    Spark itself. Done once per SparkContext.
    """
    import zipfile

    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="quire-pkg-"), "quire.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, dirnames, filenames in os.walk(pkg_dir):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for f in filenames:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
