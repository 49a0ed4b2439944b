"""Session helpers: a local builder for tests and the shared scratch folder.

On a cluster the session is built by the launcher; the library only reads
``spark.checkpoint.dir`` from it.  A local default is set only when the
setting is absent (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_ROOT = os.path.join(tempfile.gettempdir(), "textmill-checkpoints")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "textmill") -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # the rule expressions are large; plan strings nest them per stage
        .config("spark.sql.maxPlanStringLength", "200000")
        .config("spark.sql.debug.maxToStringFields", "100")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the session's setting, else the folder
    the launcher gave the context.  Only a local master gets a default; on a
    cluster a machine-local folder would lose data, so that is an error."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = _LOCAL_CHECKPOINT_ROOT
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (never machine-local
    on a cluster, since the cluster names that folder)."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, through the file system that
    Spark itself uses.  Anything outside the checkpoint folder is refused."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    if not path.startswith(f"{root}/") or len(path) <= len(root) + 1 or ".." in path:
        raise ValueError(f"{path} is not below {root}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def ship_package(spark: SparkSession) -> None:
    """Make ``textmill`` importable in Python workers (UDFs reference its
    functions): zip the package into the shared folder once per session and
    register it with ``addPyFile``, which distributes it to every executor."""
    if spark.conf.get("textmill.shipped", "false") == "true":
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = scratch_path(spark, "pyfiles")
    local_base = base[len("file:"):] if base.startswith("file:") else base
    if "://" in local_base:  # a remote shared folder: build locally, then add by URI
        local_base = os.path.join(tempfile.mkdtemp(prefix="textmill-zip-"), "textmill")
    os.makedirs(os.path.dirname(local_base) or ".", exist_ok=True)
    archive = shutil.make_archive(local_base, "zip", root_dir=os.path.dirname(pkg_dir), base_dir="textmill")
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("textmill.shipped", "true")


def reliable_checkpoint(df):
    """Reliable checkpoint (shared folder) that computes ``df`` once: the
    checkpoint write would otherwise recompute the whole plan after the
    action that materialises it."""
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist()
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
