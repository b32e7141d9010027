"""Session helpers: building a session, UTC time, shared work folders.

Work folders (stream checkpoints, sinks, lineage cuts) live under the folder
the cluster names in ``spark.checkpoint.dir``.  Only where that setting is
unset (tests, a laptop) is a fresh local folder created and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark") -> SparkSession:
    """Session for local runs and tests (UTC, AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config(STATE_STORE, ROCKSDB)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Event times are instants written in UTC; pin the session zone.

    The given tables store zone-less timestamps that mean UTC; casting them to
    instants, window alignment on day boundaries and ISO text all depend on
    the session zone, so every entry point calls this first.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or a directory already set
    with ``setCheckpointDir``).  Where none is named, a local temp folder is
    registered on a ``local`` master (tests, a laptop); on a cluster that is an
    error, because no other machine could read it.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    root = sc.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(root)
    return sc._jsc.sc().getCheckpointDir().get()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never-used path under the shared checkpoint root.

    Nothing is created here; Spark writers and stream checkpoints create
    their own folders, on whatever file system the root lives on.
    """
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tidemark/{label}-{uuid.uuid4().hex}"


def session_with(spark: SparkSession, **settings: str) -> SparkSession:
    """A session beside ``spark`` (same settings, views and context) with some
    settings of its own; ``spark`` and what runs on it are not touched.  Dots
    in names are written as ``__``."""
    beside = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for name, value in settings.items():
        beside.conf.set(name.replace("__", "."), value)
    return beside


def with_rocksdb(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose streams keep their state in RocksDB, which
    ``transformWithState`` needs; the given session may have Spark's default store."""
    return session_with(spark, **{STATE_STORE.replace(".", "__"): ROCKSDB})
