"""Cutting lineage between rounds of iterative operators, and the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only where driver and executors are one process."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named and sc.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="foliospark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` from a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a table in the shared folder: computed once, also where a checkpoint would compute it twice."""
    path = f"{shared_dir(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
