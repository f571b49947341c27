"""Session helpers.

On a cluster the session comes configured; ``get_session`` only fills in what
is unset, so tests and the bench get a sane local setup without overriding a
cluster's own ``spark.checkpoint.dir`` or shuffle sizing.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no Python call-site capture per DataFrame call (error context only): cuts driver round trips
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.driver.memory": "8g",
}


def _is_set(key: str) -> bool:
    """Whether ``spark-submit``, its arguments or a running JVM already name the key."""
    from pyspark import SparkConf, SparkContext
    if SparkContext._gateway is not None:
        return SparkConf().contains(key)
    given = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    return key in given or (key == "spark.driver.memory" and "--driver-memory" in given)


def get_session(master: str | None = None, app: str = "adpulse", **conf) -> SparkSession:
    """A session with the caller's settings; defaults only fill what nobody has set."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**{k: v for k, v in _LOCAL_DEFAULTS.items() if not _is_set(k)}, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory. A cluster names a shared
    folder in ``spark.checkpoint.dir``; only a ``local[...]`` session, which is
    a single machine, may go without and gets a scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="adpulse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``adpulse`` importable in executor Python workers (pandas UDFs and
    ``applyInPandas`` functions are pickled by reference to this package):
    zip the package once per application and ``addPyFile`` it, the same
    thing ``spark-submit --py-files`` does. Idempotent."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = tempfile.mkdtemp(prefix="adpulse-pyfiles-")
    zpath = os.path.join(out, "adpulse.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for cur, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(cur, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
