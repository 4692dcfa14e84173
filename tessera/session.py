"""Session helpers: building a session for tests/bench and finding shared scratch space.

On a cluster the session is supplied by the caller; nothing here overrides
settings that are already present.  The only thing we ever set on an existing
session is a checkpoint directory, and only when the cluster did not name one
(local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_PKG_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera") -> SparkSession:
    """Session for local runs.  AQE on, UI off, UTC clock, Arrow on."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    # local Python workers inherit this environment from the JVM
    pp = os.environ.get("PYTHONPATH", "")
    if _PKG_ROOT not in pp.split(os.pathsep):
        os.environ["PYTHONPATH"] = os.pathsep.join([p for p in (_PKG_ROOT, pp) if p])
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting a local one only if unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; we read it
    from the session.  Only when nothing is configured and all runs in one
    process (local tests) do we create a fresh temporary folder; on a cluster
    that raises, as each machine would write to its own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is not set: on {sc.master} it must name a folder "
                               "that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in executor Python workers (``addPyFile``).

    Needed for Python data sources and Arrow functions whose code lives in
    this package.  Done once per session; a no-op when the workers can
    already import the package (local sessions built by :func:`build_session`).
    """
    sc = spark.sparkContext
    if sc.getLocalProperty("tessera.shipped") == "1" or getattr(sc, "_tessera_shipped", False):
        return
    if _PKG_ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep) and sc.master.startswith("local"):
        sc._tessera_shipped = True
        return
    import shutil
    zdir = tempfile.mkdtemp(prefix="tessera-pkg-")
    archive = shutil.make_archive(os.path.join(zdir, "tessera"), "zip", _PKG_ROOT, "tessera")
    sc.addPyFile(archive)
    sc._tessera_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


#: Scratch folders handed out by this process and not yet removed.
_SCRATCH: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders handed out so far; returns how many there were.

    For a driver program to call when it has read the results of its queries:
    DataFrames that read these folders do not work afterwards.
    """
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    n = 0
    while _SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system Spark resolves it to."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
