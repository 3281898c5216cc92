"""Session acquisition and the shared working folder.

Files the library writes itself (league CSV exports, managed-table locations,
stream checkpoints) go under the folder the cluster names in
``spark.checkpoint.dir``; that folder is shared by every executor, so the
files outlive any single executor.  Only when the setting is absent
(local runs, tests) does the library pick a folder of its own and register
it as the checkpoint dir.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_shipped: set[str] = set()


def get_session(
    master: str | None = None,
    app_name: str = "oddsframe",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the settings the library relies on.

    AQE stays on (partition coalescing after the tiny-cardinality aggregates);
    the UI stays off for non-interactive runs.  ``hugeMethodLimit`` = 8000
    keeps every generated method small enough for the HotSpot JIT (a wider
    one would run interpreted); Spark then splits the wide silver projection
    into several compiled operators.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Static: skips recording a Python call site on every Column call
        # (several JVM round trips each); only error messages lose that line.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names.

    A session that names none gets a private folder only if driver and
    executors are one machine (a ``local`` master, as in tests); on any other
    master that is an error, since executors would write where nobody else can
    read.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that driver and executors share")
    root = tempfile.mkdtemp(prefix="oddsframe-ckpt-")
    # Core setting: registered on the context, read back above next time.
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, uniquely named folder under the shared checkpoint root, removed
    with all its files when the driver's JVM ends."""
    root = checkpoint_root(spark)
    # Hadoop-style URIs (hdfs://, s3a://) are joined as text; plain paths via os.
    sep = "/" if "://" in root else os.sep
    path = root.rstrip("/\\") + sep + f"oddsframe-{purpose}-{uuid.uuid4().hex[:12]}"
    remove_at_exit(spark, path)
    return path


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Let Hadoop's file system delete ``path`` when the driver's JVM ends."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on executors that do not have it on their
    path (a no-op where ``PYTHONPATH`` names its folder already)."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here in known or spark.sparkContext.applicationId in _shipped:
        return
    # Spark serves the archive from the driver's disk while the session runs.
    folder = tempfile.mkdtemp(prefix="oddsframe-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(folder, f"{package}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for top, _, names in os.walk(os.path.join(here, package)):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(top, name), os.path.relpath(os.path.join(top, name), here))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(spark.sparkContext.applicationId)


def unique_name(prefix: str) -> str:
    """A catalog-safe unique identifier, e.g. for a throwaway database."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
