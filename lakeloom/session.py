"""Session construction and the shared scratch folder.

The session settings are the ones every pipeline in this package assumes: UTC session
zone (timestamps compare like the SQL oracle), AQE with skew-join splitting and no UI server.
Writers that replace only some partitions say so themselves; no function changes its caller's session.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # sides whose size is known to be under 10 MB are broadcast without being shuffled first;
    # AQE decides the rest from sizes it measures
    "spark.sql.autoBroadcastJoinThreshold": "10485760",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state lives in RocksDB (off-heap, spills to local disk, checkpointed to the
    # shared folder) so windows/sessions/dedupe state is not bounded by executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app: str = "lakeloom",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ship_package(spark)
    # session-level settings also apply when getOrCreate returned an existing session
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform and points at shared storage. Only when it
    is unset (local tests) do we create one and register it, so that ``checkpoint()``
    and our intermediate tables have a home.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - key absent
            root = None
    if not root:
        existing = sc.getCheckpointDir()
        if existing:
            # getCheckpointDir returns <root>/<uuid>; keep using that folder
            return existing
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lakeloom-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root for written tables."""
    root = checkpoint_root(spark)
    return f"{root}/lakeloom/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the path's file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder on the path's file system; False if there was none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


@contextlib.contextmanager
def conf_set(spark: SparkSession, key: str, value: str):
    """A session setting that holds inside a ``with`` block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def own_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with this package's settings; the caller's stays as it is."""
    own = spark.newSession()
    for k, v in {**spark.conf.getAll, **DEFAULTS}.items():
        if k.startswith("spark.sql.") and own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder and return a DataFrame reading it.

    Used when a table is rewritten from itself, and before iterative loops; a reliable
    checkpoint survives the loss of the executors that computed it.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage, also of plans that have run empty."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, partitions: int | None = None):
    """``df`` dealt round-robin to ``partitions`` tasks, for expensive per-row work on few large files.

    ``None`` leaves the scan's own partitions; the plan never depends on the size of the input.
    """
    return df.repartition(partitions) if partitions else df


def spread_scan(df):
    """``df`` dealt to the session's parallelism if its files make fewer tasks than that."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return spread(df, tasks) if df._jdf.rdd().getNumPartitions() < tasks else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lakeloom`` importable in Python workers (pandas UDFs pickle functions by module).

    Equivalent of ``--py-files``: the package is zipped once per application into the shared
    folder and registered with ``addPyFile``. Skipped when the workers can already import it
    (e.g. the package is installed on the cluster image).
    """
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark).replace("file:", "")
    if "://" in root:  # remote shared storage: stage the zip locally; addPyFile distributes it
        root = tempfile.mkdtemp(prefix="lakeloom-pkg-")
    os.makedirs(f"{root}/lakeloom", exist_ok=True)
    target = f"{root}/lakeloom/lakeloom-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
