"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Wide records make long generated methods. The JVM never compiles a method
# above 8000 bytecodes, so for wide rows, and beyond that limit, Spark should
# use its per-operator projections, which are split into small methods.
# Inferring constraints compares every pair of derived columns and does not
# end in useful time on such records.
SETTINGS = {
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.codegen.maxFields": "60",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the wide plans rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in spark.checkpoint.dir.

    Only where the cluster names none (local runs, tests) a temporary folder
    is made and registered.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
        return context.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise once in the shared folder, so a lost executor costs no recompute."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
