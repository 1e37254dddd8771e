"""Session helpers: building a session for tests/bench and locating the
shared checkpoint folder.

Cluster jobs must cut lineage into the shared folder the cluster names in
``spark.checkpoint.dir``. We read that setting from the session and only set
our own folder when it is unset and the master is local (tests, bench).
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF_KEY = "spark.checkpoint.dir"

# Spark's documented setting for HotSpot: a whole-stage method above 8000
# bytes of bytecode is never JIT-compiled, so let such a stage fall back to
# per-operator code instead of running interpreted (3x faster on the
# report-parsing stage).
HUGE_METHOD_KEY = "spark.sql.codegen.hugeMethodLimit"
HUGE_METHOD_LIMIT = "8000"


def apply_codegen_limit(spark: SparkSession) -> None:
    """Set the huge-method limit unless the user set one."""
    if spark.conf.get(HUGE_METHOD_KEY, "65535") == "65535":
        spark.conf.set(HUGE_METHOD_KEY, HUGE_METHOD_LIMIT)


# Rows of one Arrow batch between Spark and Python. A batch of whole texts is
# held by the JVM, outside its heap, and by the worker; Spark's 10,000 rows are
# tens of megabytes in each of them, kept after the batch is gone.
BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "1000"


def apply_batch_rows(spark: SparkSession) -> None:
    """Set the rows of an Arrow batch unless the user set them."""
    if spark.conf.get(BATCH_ROWS_KEY, "10000") == "10000":
        spark.conf.set(BATCH_ROWS_KEY, BATCH_ROWS)


def build_session(master: str | None = None, app: str = "adlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench: local master, AQE on, UI off, UTC."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("ADLENS_DRIVER_MEMORY", "16g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config(HUGE_METHOD_KEY, HUGE_METHOD_LIMIT))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when
    the session has none and runs in local mode."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf = spark.conf.get(_CONF_KEY, None) or (sc.getConf().get(_CONF_KEY, None) if sc is not None else None)
    if not conf:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared "
                "folder for checkpoints and intermediate tables")
        conf = tempfile.mkdtemp(prefix="adlens-ckpt-", dir="/tmp")
    if sc is None:
        return conf
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def default_parallelism(spark: SparkSession) -> int:
    """Cores of the cluster (shuffle partitions when there is no context)."""
    sc = _context(spark)
    return sc.defaultParallelism if sc is not None else int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, kind: str, keep: bool = False) -> str:
    """A fresh folder under the shared checkpoint folder for written
    intermediate tables (never a machine-local temp dir on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/adlens-{kind}-{uuid.uuid4().hex[:12]}"
    if not keep and (paths := _SCOPE.get()) is not None:
        paths.append(path)
    return path


_SCOPE: contextvars.ContextVar[list | None] = contextvars.ContextVar("adlens_scratch", default=None)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete every scratch folder made inside the block when it ends, whether
    it succeeds or fails. What the block returns must not read them."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in paths:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system (no-op without a context)."""
    sc = _context(spark)
    if sc is None:
        return
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
