"""Session settings and scratch storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Runtime SQL settings the operators rely on at scale.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join keys even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # needed by custom keyed state on streams
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # merge sessions on the map side, so a hot key ships sessions and not rows
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "olapflow", cores: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster must
    name one, since executors cannot share a machine-local path.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="olapflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, in a folder of this application that goes when
    its driver ends."""
    context = spark.sparkContext
    root = os.path.join(shared_dir(spark), "olapflow", context.applicationId)
    folder = context._jvm.org.apache.hadoop.fs.Path(root)
    store = folder.getFileSystem(context._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder, by columns, and read it back: a cut in the
    lineage that outlives executors. Types without a file form are checkpointed as rows."""
    kinds = df.schema.simpleString()
    if "void" in kinds or "interval" in kinds:
        return checkpointed(df)
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_measured(df: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``stored``, with aggregates of the rows taken by the job that writes them. A task that
    runs twice may count twice, so nothing that must be exact may rest on a sum."""
    seen = Observation()
    out = stored(df.observe(seen, *[c.alias(name) for name, c in measures.items()]), label)
    return out, seen.get
