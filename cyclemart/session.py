"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Skewed joins are split even where the split costs a further shuffle: one hot customer, product
# or document must not decide how long a stage takes.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Loads of several steps would otherwise keep the shuffle files of all of them until the driver's next collection.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def build_session(name: str = "cyclemart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A temporary folder stands in only when nothing is set and the session is local.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="cyclemart-")
        context.setCheckpointDir(folder)
    return folder


def working_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several plans read, and read it back: the lineage ends here, and later
    plans prune columns and skip row groups on it."""
    path = working_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
