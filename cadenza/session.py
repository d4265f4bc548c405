"""Session construction and the shared work folder.

Jobs that cut lineage (``DataFrame.checkpoint``) or land intermediate tables
write under the folder the cluster names in ``spark.checkpoint.dir``.  Only
when the session has none (local runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session gets: adaptive execution re-plans joins and
# partition counts from real shuffle sizes and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files of released DataFrames are removed by the context cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20,
               max_partitions: int = 200_000) -> dict:
    """Settings that size work to the data: about ``partition_bytes`` per file
    split and per shuffle partition, so tasks fit executor memory and spill
    only rarely. The initial shuffle partition count covers the whole input;
    AQE merges small partitions at run time and splits skewed ones (a partition
    over 5x the median and over ``partition_bytes``) in sort-merge joins.

    For 100 TB at 256 MB that is about 400,000 splits to read and a shuffle
    started at the cap of 200,000 partitions, merged down by AQE."""
    parts = max(8, min(max_partitions, -(-int(input_bytes) // partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        # Static broadcasts stay small; bigger sides go through the checked paths.
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "cadenza", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001  (Connect sessions have no SparkContext)
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = _context(spark)
    if sc is None:
        # Spark Connect: the server checkpoints into its own configured folder.
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # A machine-local folder is not shared by the executors.
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can "
                               "reach (checkpoints and landed tables are written there)")
        # Local / test sessions only: a cluster sets spark.checkpoint.dir.
        configured = tempfile.mkdtemp(prefix="cadenza-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_WORK: list[str] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a landed table, next to the checkpoint data. It stays until
    :func:`clean_work`, as lazy results may still read it."""
    base = ensure_checkpoint_dir(spark)
    _WORK.append(os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}"))
    return _WORK[-1]


def clean_work(spark: SparkSession) -> int:
    """Delete the landed tables of this application: call it when a run's results have been
    written. Returns how many folders were dropped."""
    from cadenza.sources import storage

    paths, _WORK[:] = list(_WORK), []
    for path in paths:
        storage.delete(spark, path)
    return len(paths)


_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> str:
    """Make this package importable by Python workers (stages that run
    ``mapInArrow``): zip it once per application into the shared folder and
    add it with ``SparkContext.addPyFile``, the standard way to ship code."""
    import zipfile

    sc = _context(spark)
    app = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if app in _SHIPPED:
        return _SHIPPED[app]
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    target_dir = os.path.join(ensure_checkpoint_dir(spark) or tempfile.mkdtemp(), "pyfiles")
    if "://" in target_dir and not target_dir.startswith("file:"):
        # Remote shared folder: addPyFile also accepts a local file, which
        # Spark copies to every executor.
        target_dir = tempfile.mkdtemp(prefix="cadenza-pkg-")
    target_dir = target_dir.replace("file:", "", 1) if target_dir.startswith("file:") else target_dir
    os.makedirs(target_dir, exist_ok=True)
    path = os.path.join(target_dir, f"cadenza-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(path)
    else:
        spark.addArtifacts(path, pyfile=True)
    _SHIPPED[app] = path
    return path
