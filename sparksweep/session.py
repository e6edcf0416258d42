"""Session and shared-folder helpers.

The library itself never builds a session. ``local_session`` is for tests and
the bench. ``shared_dir`` hands out fresh folders under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``); a machine-local folder is only
made when the setting is unset and Spark runs in local mode.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sparksweep", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.python.worker.reuse", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    extra = dict(extra or {})
    if _CHECKPOINT_KEY not in extra:  # tests and the bench: a local folder of their own
        extra[_CHECKPOINT_KEY] = tempfile.mkdtemp(prefix="sparksweep-ckpt-")
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Falls back to the SparkContext checkpoint folder; with neither set, a folder
    of our own is set in local mode (one process, as in tests), and on any cluster it raises.
    """
    root = spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        try:
            root = spark.conf.get(_CHECKPOINT_KEY, None)
        except Exception:  # pragma: no cover - conf lookups differ by mode
            root = None
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^-]*\])?", master):  # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder every executor shares")
        root = tempfile.mkdtemp(prefix="sparksweep-ckpt-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}sparksweep/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def plan_bytes(df: DataFrame) -> int:
    """The size of the tables that a plan reads, by the optimizer's statistics; nothing is run for it. (Its
    estimate for the result itself multiplies the sides of joins.)"""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def remove_scratch(spark: SparkSession) -> None:
    """Delete everything that this application wrote with ``shared_dir``; results
    that read from there can't be read afterwards."""
    path = shared_dir(spark, "none").rsplit("/", 1)[0]
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sparksweep`` importable in every Python worker (pandas functions,
    Arrow sources, stateful processors) by shipping it with ``addPyFile``.
    Done once per SparkContext; a no-op afterwards."""
    import os
    import zipfile

    import sys

    from pyspark import cloudpickle

    # Code sent to Python processes the driver starts itself (stateful
    # processors, data-source planning) does not see shipped files: pickle
    # the package's functions and classes by value so they need no import.
    cloudpickle.register_pickle_by_value(sys.modules[__name__.rsplit(".", 1)[0]])
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="sparksweep-pkg-"), "sparksweep.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
