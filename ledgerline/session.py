"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, app: str = "ledgerline") -> SparkSession:
    """A local[N] session configured like the cluster one (AQE, no UI)."""
    parts = shuffle_partitions or cpus
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name shared storage and is only read.  A
    local-mode session without it (tests) gets a fresh temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect exposes no SparkContext; the server owns the setting
        sc = None
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder name under the shared checkpoint folder (Spark's writers create it)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/ledgerline/{label}-{uuid.uuid4().hex}"


MAX_SHUFFLE_PARTITIONS = 1 << 16


def recommended_conf(ledger_bytes: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a cluster run over a ledger of ``ledger_bytes`` (on storage).

    Shuffle partitions are sized so that one holds about ``target_partition_bytes``
    of ledger (AQE coalesces small ones and splits skewed join partitions),
    capped at 65,536: shuffle blocks grow as mappers x reducers, so past the
    cap partitions grow instead and sorts spill.  Scans read splits of the
    target size.  A join on account and number may run on rows hashed on the
    account alone (``operators.copartition`` keeps large accounts out of it).
    """
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(200, -(-int(ledger_bytes) // target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerline`` importable in the Python workers (what ``--py-files`` does).

    Only the streaming step runs Python on executors.  Unless the application
    was submitted with the package in ``spark.submit.pyFiles``, the package is
    zipped once per application and added with ``addPyFile`` (the zip is a code
    artifact served by the driver; it goes under the checkpoint folder when that
    is a local path, else the driver's temp folder).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: ship with --py-files / artifacts instead
        return
    if getattr(sc, "_ledgerline_shipped", False):
        return
    if "ledgerline" in (sc.getConf().get("spark.submit.pyFiles", "") or ""):
        sc._ledgerline_shipped = True
        return
    import io
    import os
    import zipfile

    import ledgerline

    root = os.path.dirname(os.path.abspath(ledgerline.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.join("ledgerline", os.path.relpath(full, root)))
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    if "://" in base:
        base = tempfile.gettempdir()
    target = os.path.join(base.rstrip("/"), "ledgerline", f"pyfiles-{uuid.uuid4().hex}", "ledgerline.zip")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with open(target, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(target)
    sc._ledgerline_shipped = True
