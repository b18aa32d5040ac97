"""Session helpers: one place for the settings every job relies on.

The library never creates a cluster session on its own; ``get_session`` is for tests, the bench and local runs.
On a cluster the caller's session is used as is, and only settings that are unset get a default.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings the operators depend on for their documented semantics.
REQUIRED_CONF = {
    # The reference's dict semantics: a repeated key keeps the last value (AG-14).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # No zones anywhere in the data; wall-clock timestamps are read and written as UTC.
    "spark.sql.session.timeZone": "UTC",
}

# Defaults tuned for scale; applied only when the session leaves them unset.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "snapmetrics") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    for k, v in {**SCALE_DEFAULTS, **REQUIRED_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to an existing session; scale defaults only where unset. The package is
    shipped to the executors' Python workers (needed by the stateful streaming function)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in SCALE_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Zip this package once per application and add it with ``SparkContext.addPyFile`` — what ``--py-files``
    does at submit time — so Python workers on every executor can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="snapmetrics-pyfiles-"), "snapmetrics.zip")
    with zipfile.ZipFile(out, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Where the session names none, a local session (one process: tests, the bench) gets a scratch folder of its own; on
    a cluster the executors could not see such a folder, so the job fails with a clear message instead.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="snapmetrics-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for a written intermediate table: below the shared checkpoint folder, one root for each application, which
    is deleted when the driver's Python ends."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"
    _SCRATCH.setdefault(root, spark)
    return f"{root}/{name}"


@atexit.register
def _drop_scratch() -> None:
    for root, spark in _SCRATCH.items():
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the session has ended: a folder of this machine can still be removed
            shutil.rmtree(root.removeprefix("file://"), ignore_errors=True)
