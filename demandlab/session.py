"""Session helpers: sane defaults for local runs and a shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "demandlab", driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    In this order: the folder already set on the context, the setting
    ``spark.checkpoint.dir``, a scratch folder when the master is local
    (tests). On a cluster without either, this raises: a machine-local folder
    would not be visible to the other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        sc = None
    conf = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    held = sc.getCheckpointDir() if sc is not None else None
    if held is not None:
        # Spark keeps a folder of its own inside the one it was given
        return conf if conf and _plain(held).startswith(_plain(conf) + "/") else held
    if not conf:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="demandlab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf)
    if sc is not None:
        sc.setCheckpointDir(conf)
    return conf


def _plain(path: str) -> str:
    return re.sub(r"^file:/*", "/", path).rstrip("/")


def scratch_table(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``demandlab`` importable in the Python workers of every executor.

    Operators that run Python on executors (``mapInPandas`` Gram and bootstrap
    passes, the p-value pandas UDF) call this once per application: the package
    is zipped on the driver and distributed with ``addPyFile`` (``addArtifacts``
    on a remote session), the standard way to ship Python code to a cluster.
    """
    import zipfile

    import demandlab
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # noqa: BLE001 - remote session
        sc, key = None, id(spark)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(demandlab.__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="demandlab-pkg-"), "demandlab.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(key)
