"""Session helpers: a configured SparkSession and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC clock (DuckDB compares naive timestamps),
# ANSI arithmetic, adaptive execution with skew splitting and partition coalescing.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings sized for a given input and cluster so that partitions fit in executor memory.

    * shuffle partitions: about ``target_partition_bytes`` of input each (at least
      two waves of tasks), AQE then coalesces small ones and splits skewed ones;
    * file splits of ``min(target, 512 MiB)`` for the scans;
    * skew: a partition is skewed above 5x the median and 512 MiB.
    For 100 TB on 1000 x 8 cores this gives ~400k shuffle partitions of 256 MiB.
    """
    slots = executors * cores_per_executor
    partitions = max(2 * slots, -(-input_bytes // target_partition_bytes))
    split = min(target_partition_bytes, 512 * 1024 * 1024)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionNum": str(slots),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one (local only when no master is given)."""
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("QUARRY_MASTER")
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no driver-side context
        return None


def parallelism(spark: SparkSession) -> int:
    """Task slots of the application (shuffle partitions when there is no driver-side context)."""
    sc = _context(spark)
    return sc.defaultParallelism if sc is not None else int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting must exist: a machine-local folder would be lost
    together with the executor that wrote it.  Only a local-mode session
    (tests, the bench) gets a private folder under the system temp dir.
    """
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared (HDFS/object store) folder")
    local = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder (for staged files)."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this application staged under :func:`scratch_path`; the number of paths.

    Call it when no DataFrame built so far is needed any more (the jobs do at their end)."""
    sc = _context(spark)
    n = 0
    while sc is not None and _SCRATCH:
        path = sc._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))
    return n


_SHIPPED: set[str] = set()


def ensure_importable(spark: SparkSession) -> None:
    """Ship this package to the Python workers once per application (``addPyFile``).

    Readers, writers and pandas UDFs run module functions of ``quarry`` inside
    tasks; workers must import it whatever their working directory.  The zip is
    built in memory and written to the shared checkpoint folder, from where
    Spark distributes it.  When the package was already shipped
    (``--py-files``) the extra copy is harmless.
    """
    import hashlib
    import io
    import zipfile

    import quarry

    sc = _context(spark)
    app = sc.applicationId if sc is not None else f"connect-{spark.session_id}"
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(quarry.__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in sorted(os.walk(pkg_dir)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    data = buf.getvalue()
    if sc is not None:
        from quarry.sources.fsutil import write_atomic

        digest = hashlib.sha1(data).hexdigest()[:12]
        target = f"{checkpoint_dir(spark).rstrip('/')}/pyfiles/{digest}/quarry.zip"
        write_atomic(target, [data])
        sc.addPyFile(target)
    else:  # Spark Connect: upload as a session artifact
        zpath = os.path.join(tempfile.mkdtemp(prefix="quarry-pyfiles-"), "quarry.zip")
        with open(zpath, "wb") as f:
            f.write(data)
        spark.addArtifacts(zpath, pyfile=True)
    _SHIPPED.add(app)
