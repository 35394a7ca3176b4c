"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library expects.  AQE re-plans joins and coalesces shuffle
# partitions at run time; the session time zone is pinned so that timestamp
# text is the same on every executor.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# Broadcast policy: no broadcast from planning-time estimates (a small Parquet
# file can be many times larger in memory); AQE still turns a join into a
# broadcast once the measured size of a finished shuffle stage is under its
# own threshold, so every broadcast has a measured size bound.
MEASURED_BROADCAST_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "plait", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    On a cluster this is what ``spark.checkpoint.dir`` names (a path every
    executor can reach).  Only when nothing is configured, as in local
    tests, a private folder is created and registered.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="plait-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location below the shared folder."""
    base = shared_dir(spark)
    name = "-".join(p for p in parts if p) + "-" + uuid.uuid4().hex[:12]
    return os.path.join(base, "plait", name) if "://" not in base else f"{base}/plait/{name}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``plait`` importable in the Python workers (needed where plait
    code runs inside tasks, i.e. ``fetch``), once per SparkContext: the
    package is zipped (named by a hash of its files) and added with
    ``addPyFile``, which distributes it like ``spark-submit --py-files``.
    The zip is written below the shared folder when that is a local path,
    else next to the driver for Spark to serve."""
    import hashlib
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_plait_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    files = []
    for d, _dirs, names in os.walk(root):
        if "__pycache__" in d:
            continue
        files += [os.path.join(d, n) for n in sorted(names) if n.endswith(".py")]
    digest = hashlib.sha256()
    for f in sorted(files):
        with open(f, "rb") as fh:
            digest.update(f.encode() + fh.read())
    base = shared_dir(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    folder = os.path.join(local, "plait", "code") if "://" not in local else tempfile.mkdtemp(prefix="plait-code-")
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, f"plait-{digest.hexdigest()[:12]}.zip")
    if not os.path.exists(target):
        tmp = f"{target}.{uuid.uuid4().hex[:6]}"
        with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
            for f in files:
                z.write(f, os.path.join("plait", os.path.relpath(f, root)))
        os.replace(tmp, target)
    sc.addPyFile(target)
    sc._plait_shipped = True
