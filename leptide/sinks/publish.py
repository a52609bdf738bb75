"""Validate, then publish: staged writes that become visible in one rename."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.audit import Findings, enforce


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop = spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(hadoop), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, Path = _filesystem(spark, path)
    return bool(fs.exists(Path(path)))


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    target: str,
    verify: Callable[[Mapping[str, DataFrame]], Findings] | None = None,
    *,
    overwrite: bool = False,
    success_marker: str | None = "SUCCESS",
) -> None:
    """Write the tables to a private sibling, verify what was written, rename.

    Nothing appears at `target` before every rule passes on the tables as read
    back. An existing target is kept unless `overwrite` is set; then it is moved
    aside first and removed only after the new one stands.
    """
    target = target.rstrip("/")
    if exists(spark, target) and not overwrite:
        raise FileExistsError(f"output already exists: {target}")
    staging = f"{target}.partial-{uuid.uuid4().hex}"
    fs, Path = _filesystem(spark, staging)
    try:
        for name, df in tables.items():
            df.write.mode("errorifexists").parquet(f"{staging}/{name}")
        written = {name: spark.read.parquet(f"{staging}/{name}") for name in tables}
        if verify is not None:
            enforce(verify(written))
        if success_marker:
            fs.create(Path(f"{staging}/{success_marker}")).close()
        aside = f"{target}.replaced-{uuid.uuid4().hex}"
        replaces = exists(spark, target)
        if replaces and not overwrite:
            raise FileExistsError(f"output appeared meanwhile: {target}")
        if replaces and not fs.rename(Path(target), Path(aside)):
            raise OSError(f"could not move the old {target} aside")
        if not fs.rename(Path(staging), Path(target)):
            if replaces:
                fs.rename(Path(aside), Path(target))
            raise OSError(f"could not publish {target}")
        if replaces:
            fs.delete(Path(aside), True)
    except BaseException:
        fs.delete(Path(staging), True)
        raise
