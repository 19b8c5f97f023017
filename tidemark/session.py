"""Session helpers: a local session for tests and a shared work directory.

Jobs that materialise intermediate tables (layout round-trips, streaming sinks,
lineage cuts) write under the directory the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (local tests) do we
create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the local bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for k, v in _CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job relies on (UTC, AQE); safe on a shared session.

    Also ships this package to the executors (once per application), so the
    Arrow codecs and state functions import on workers wherever the driver
    was started from.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """``addPyFile`` a zip of the package (what ``--py-files`` does at submit)."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    fd, zpath = tempfile.mkstemp(prefix="tidemark-pkg-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


_LOCAL_ROOT: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set one only if unset.

    ``spark.checkpoint.dir`` is a static setting: a session without it (local
    tests) gets a fresh folder through ``setCheckpointDir`` instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
        return root
    app = spark.sparkContext.applicationId
    master = spark.sparkContext.master or ""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_ROOT[app])
    return _LOCAL_ROOT[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}tidemark/{name}-{uuid.uuid4().hex[:12]}"


def local_dir(path: str) -> str:
    """Strip a ``file:`` scheme for local-filesystem checks in tests."""
    return path[5:] if path.startswith("file:") else path
