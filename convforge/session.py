"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splits oversized join partitions; duplicate
# JSON keys keep the last value, as Python's decoder does.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Checkpoint files of materialised intermediates are removed once the
    # checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Long-lived sessions: let the cleaner find unreferenced shuffle,
    # broadcast and checkpoint data every few minutes (default 30).
    "spark.cleaner.periodicGC.interval": "5min",
}


def get_spark(master: str | None = None, app: str = "convforge",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    On a cluster ``master`` stays None so spark-submit decides; locally
    pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Set the runtime-settable parts of CORE_CONF on an existing session and
    make the package importable by the Python workers."""
    for k, v in CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass
    ship_package(spark)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors once per application.

    Generators, scorers and the JSON decoder run in Python workers, which
    import ``convforge`` by name; ``addPyFile`` ships a zip of the package
    with the job, on a cluster as in local mode.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    # Images that install the package on every worker can turn this off.
    if spark.conf.get("spark.convforge.shipPackage", "true").lower() == "false":
        _SHIPPED.add(app)
        return
    # The zip is code, built on the driver; Spark's file server hands it to
    # the executors (as with --py-files), which never read the driver path.
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="convforge-pkg-"), "convforge.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when a session whose executors run in the driver's process has none
    (unit tests, a bare local session) is a private temporary folder created
    and registered; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="convforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/convforge/{name}-{uuid.uuid4().hex[:12]}"


def write_through(df, name: str):
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Like ``materialize``, for results of which later steps read some columns or
    rows only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df, spark: SparkSession | None = None):
    """Write ``df`` to the shared checkpoint folder and continue from there.

    For results read by several later steps: they are computed once, the
    lineage is cut, and a lost executor recomputes nothing before this
    point.  Uses reliable ``checkpoint()`` (never local checkpoints).
    """
    checkpoint_root(spark or df.sparkSession)
    return df.checkpoint(eager=True)
