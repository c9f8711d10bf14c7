"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set on a session of our own and, where possible, on one handed in by a caller.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # HotSpot does not compile methods above 8,000 bytecodes; wide typed projections exceed that in
    # whole-stage code and run faster as split projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A re-run of one data-quality run replaces only that run's partition.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The shuffles of a query are deleted once it is done. Otherwise they lie on disk until the driver happens to collect
    # garbage, and a session of many queries adds them up.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Fixed once a session has started, so only for sessions of our own.
START_SETTINGS = {
    # Stack traces per column expression cost more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Settled intermediate results are deleted once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_WORK_ROOTS: dict[str, str] = {}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None, app: str = "medledger") -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**START_SETTINGS, **RUNTIME_SETTINGS}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def work_root(spark: SparkSession) -> str:
    """A folder of this application's own under the cluster's shared checkpoint folder.

    Only when the session names no folder (tests, a laptop) is a temporary one made and set.
    """
    app = spark.sparkContext.applicationId
    if app not in _WORK_ROOTS:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
            "spark.checkpoint.dir", None)
        if not shared:
            shared = spark.sparkContext.getCheckpointDir()
        if not shared:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="medledger-")
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(shared)
        _WORK_ROOTS[app] = f"{shared.rstrip('/')}/medledger-{app}-{uuid.uuid4().hex[:8]}"
    return _WORK_ROOTS[app]


def settle(df: DataFrame) -> DataFrame:
    """Write an intermediate result to the checkpoint folder and cut its lineage there."""
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)
