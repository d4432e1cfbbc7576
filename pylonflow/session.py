"""Session helpers: settings the engine relies on, and the shared checkpoint root."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every pylonflow job assumes. Time zone UTC keeps window boundaries
# and timestamp rendering stable; AQE re-plans joins/partition counts at runtime.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


# The only setting results depend on; pinned on whatever session we are given.
# Performance settings (AQE etc.) are left to the session owner.
REQUIRED_CONF = {"spark.sql.session.timeZone": "UTC"}


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Pin the result-relevant settings on an existing session (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pylonflow") -> SparkSession:
    """Session for tests and the bench; production code receives its session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.python.worker.reuse", "true")
        .config("spark.speculation", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Python call-site capture for error messages costs several py4j
        # round-trips per column function while plans are being built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}
_ROOT_LOCK = threading.Lock()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without the setting the context's checkpoint directory is used, if one
    was set. On a cluster one of the two must point at shared storage; we
    never invent a machine-local folder there. A local-mode session without
    either (tests) gets a scratch folder that is registered as the context's checkpoint directory
    and reused for the rest of the application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.conf.get("spark.app.id", "") or str(id(spark))
    with _ROOT_LOCK:
        if app in _LOCAL_ROOTS:
            return _LOCAL_ROOTS[app]
        existing = None
        try:
            existing = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - Spark Connect / fakes
            pass
        if not existing and not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it (or the context's checkpoint directory) at "
                "shared storage (HDFS/S3/ABFS) before running stateful or chained jobs"
            )
        if existing:
            root = existing.rstrip("/")
        else:
            # spark.checkpoint.dir is static in Spark 4: register the folder on the context instead
            root = tempfile.mkdtemp(prefix="pylonflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
            try:
                spark.sparkContext.setCheckpointDir(root)
            except Exception:  # noqa: BLE001 - Spark Connect
                pass
        _LOCAL_ROOTS[app] = root
        return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh unique location under the checkpoint root (new per call)."""
    return "/".join([checkpoint_root(spark), "pylonflow", *parts, uuid.uuid4().hex])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pylonflow`` importable by local Python workers (once per app).

    Operators that run Python on executors (the model call, the live status
    operator) pickle references to this package's functions. In local mode
    the workers run on this machine but may not share the driver's import
    path, so the package is zipped and handed to ``addPyFile``. On a cluster
    the package is deployed like any PySpark code (``spark-submit
    --py-files pylonflow.zip`` or an installed wheel) and this is a no-op; a
    package already loaded from a zip or wheel is left alone too.
    """
    import zipfile

    import pylonflow
    pkg_dir = os.path.dirname(os.path.abspath(pylonflow.__file__))
    if not os.path.isdir(pkg_dir) or not spark.conf.get("spark.master", "").startswith("local"):
        return
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        app = "connect:" + str(id(spark))
    if app in _SHIPPED:
        return
    zpath = os.path.join(tempfile.mkdtemp(prefix="pylonflow-pkg-"), "pylonflow.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    try:
        spark.sparkContext.addPyFile(zpath)
    except Exception:  # noqa: BLE001
        spark.addArtifacts(zpath, pyfile=True)
    _SHIPPED.add(app)
