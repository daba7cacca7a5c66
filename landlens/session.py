"""Session helpers: build a local session for tests/bench, tune a given one.

Only runtime SQL settings are touched on a session we did not create, and the
checkpoint directory is read from the session (``spark.checkpoint.dir``); a
directory of our own is set only when the session has none (tests, local bench).
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the library relies on. AQE re-plans joins from real
# shuffle sizes (broadcast only when the measured side is small, skew split for
# hot grid cells / hot keys) and coalesces tiny partitions.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def package_on_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (installed, or a folder all can see)."""
    root, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def tune(spark: SparkSession) -> SparkSession:
    package_on_workers(spark)
    for k, v in RUNTIME_CONF.items():
        try:
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        except Exception:  # static or locked setting on a managed cluster
            pass
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "landlens", memory: str = "16g",
                  event_log_dir: str | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", memory)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for lineage cuts, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    jd = spark.sparkContext._jsc.sc().getCheckpointDir()
    return jd.get() if jd.isDefined() else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; create a scratch one only when unset.

    On a cluster the setting must be present (shared storage) and a missing one
    is an error; a scratch folder is created only for ``local`` masters (tests,
    bench).
    """
    d = checkpoint_dir(spark)
    if d is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a shared folder is required on a cluster")
        d = tempfile.mkdtemp(prefix="landlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(d)
    else:
        jd = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not jd.isDefined():
            spark.sparkContext.setCheckpointDir(d)
    return d


_FOLDERS: dict[str, str] = {}


def stage_table(df: DataFrame) -> DataFrame:
    """Cut the lineage: a written table in the shared checkpoint folder, read back.

    Unlike a checkpoint it is columnar (later steps read only their columns), has true statistics, and does not carry
    the constraints of its plan on, which grow without bound in loops. It is compressed well, as it stays until the end. The application's tables go when its driver ends.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landlens-stages-{app}"
        atexit.register(_remove, spark, _FOLDERS[app])
    path = f"{_FOLDERS[app]}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
