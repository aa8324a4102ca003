"""The folder that driver and executors share, and tables that are written there to be read several times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder; a temporary one for a local master that has none."""
    named, sc = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not named and sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc._jsc.sc().getCheckpointDir().get()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
        named = sc._jsc.sc().getCheckpointDir().get()
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once and read from there, so that what is built on it several times isn't computed each time; lost executors lose nothing of it."""
    path = folder(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
