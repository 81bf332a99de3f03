"""Session settings and the shared working folder.

The driver may hand us its own session, so every public job calls
``configure`` first; it only touches runtime SQL settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # all stamps and date texts are UTC
    "spark.sql.session.timeZone": "UTC",
    # JSON objects with a repeated key keep the last value, like json.loads
    "spark.sql.variant.allowDuplicateKeys": "true",
    # the API source narrows its calls by pushed symbol / date filters
    "spark.sql.python.filterPushdown.enabled": "true",
    # runtime re-planning: coalesce small shuffles, split skewed ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep small-but-CPU-heavy shuffles (per-chunk arrays, parsed documents)
    # spread over the cores; large shuffles are never coalesced below this
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) do we make
    one, and register it so ``DataFrame.checkpoint`` uses the same place.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if current:
            return current
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="ticksmith-ckpt-")
    if not current:
        # named only as a session setting: register it so checkpoint() works
        sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/ticksmith/{name}-{uuid.uuid4().hex[:12]}"


def local_session(app: str = "ticksmith", cores: str = "*",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench (local mode, no web UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TICKSMITH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``ticksmith`` importable in the executors' Python workers.

    On a cluster the package is normally shipped with ``--py-files``
    (then set ``spark.ticksmith.shipped=true``).  Otherwise the package is
    zipped in memory, written into the shared checkpoint folder and added
    with ``addPyFile``, once per SparkContext.
    """
    sc = spark.sparkContext
    if getattr(sc, "_ticksmith_shipped", False):
        return
    if spark.conf.get("spark.ticksmith.shipped", "false") == "true":
        sc._ticksmith_shipped = True
        return
    import hashlib
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _dirs, names in sorted(os.walk(pkg_dir)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    data = buf.getvalue()
    digest = hashlib.sha1(data).hexdigest()[:16]
    target = f"{checkpoint_root(spark).rstrip('/')}/ticksmith/pyfiles/{digest}/ticksmith.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    sc.addPyFile(target)
    sc._ticksmith_shipped = True
