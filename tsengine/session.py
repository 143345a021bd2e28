"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (bins are computed on
# instants), AQE for runtime coalescing and skew splitting, no UI server.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tsengine", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the settings the library assumes.

    On a cluster, ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[*]``.  An existing session is reused and only runtime-settable
    options are applied to it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.driver.memory", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, conf[k])
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tsengine`` importable in Python workers (Pandas UDFs are pickled by reference).

    The package is zipped once per SparkContext and added with ``addPyFile``,
    which distributes it to every executor (the same as ``--py-files``).
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="tsengine-pyfiles-"), "tsengine.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (``DataFrame.checkpoint``).

    The cluster names it in ``spark.checkpoint.dir``; it is read from the
    session and only set here when nothing is configured (local tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="tsengine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def materialize(df):
    """Write ``df`` to the shared checkpoint folder and continue from the copy.

    Cuts the lineage of a frame that several later stages reuse (features
    feed targets, imputation and tests), so it is computed once and a lost
    executor re-reads files instead of recomputing the extraction.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
