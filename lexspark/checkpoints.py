"""Cutting lineage, and keeping files, in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; on a single machine without that setting a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir names no shared folder; a temporary folder would be another one on each machine")
    return shared or tempfile.mkdtemp(prefix="lexspark-")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the cluster's shared checkpoint folder (survives lost executors)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df, computed once and kept as Parquet files, which take less room than a checkpoint, in the cluster's shared folder."""
    path = f"{shared_folder(df.sparkSession)}/files-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
