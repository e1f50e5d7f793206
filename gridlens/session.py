"""Session construction and the shared scratch location.

Scratch data (round-trip copies, upsert versions, stream checkpoints,
lineage cuts) always lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when the session has none (unit tests, a
laptop) do we create one, so a cluster never writes to a machine-local
temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins by their real sizes
# (broadcast only what turned out small, split skewed partitions), and
# coalesces the many shuffle partitions a large cluster needs into fewer
# when a stage turns out small.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    # runtime-checked broadcast: an aggregated dimension (suburb or cell
    # counts) up to this size is broadcast instead of shuffling the rows
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # no per-call Python call-site capture while building plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Applications whose executors have this package.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Before functions of this package run in tasks: hand its code to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gridlens-ship-")) / "gridlens-code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def build_session(
    master: str | None = None,
    app_name: str = "gridlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``shuffle_partitions`` should be sized so one partition of the largest
    shuffle fits comfortably in executor memory (roughly input bytes / 128 MB
    on a cluster); local tests use the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set up if missing.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir);
    only when neither is set and the session runs on this machine alone do we
    make a fresh local one.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and (sc.master.startswith("local-cluster") or not sc.master.startswith("local")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="gridlens-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/gridlens-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut the lineage of a frame that several later passes read.

    A reliable checkpoint into the shared checkpoint folder (never a local
    checkpoint): the data survives the loss of the executors that computed
    it, and the passes that follow read it instead of recomputing the plan.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
