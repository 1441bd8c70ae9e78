"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings. The last duplicate JSON key wins, as in Python; skewed
# join partitions are split even when that costs another exchange; streaming state
# lies on disk, and a batch saves what it changed; a batch of pages sent to Python
# stays small however large the pages are.
RUNTIME_SETTINGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
}

_local_scratch: str | None = None
_run_folders: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine;
    on a cluster the executors could not see it.
    """
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="presslake-")
    return _local_scratch


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the scratch root (not created yet).

    All folders of this process lie in one folder, which is removed when the
    process ends: what a query staged may be read as long as the session lives.
    """
    root = scratch_root(spark)
    if root not in _run_folders:
        _run_folders[root] = f"{root}/presslake-run-{uuid.uuid4().hex[:12]}"
        atexit.register(_remove, spark, _run_folders[root])
    return f"{_run_folders[root]}/{name}-{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder, unless the JVM has ended already."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # at exit nothing can be done about it
        pass
