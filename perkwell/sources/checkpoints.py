"""Reliable cut points for plans that must not be computed twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    one gets a folder of its own; anything else must be configured.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="perkwell-checkpoint-")
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and continue from it.

    Unlike a checkpoint the table tells its size, so a small one is sent to the tasks of a join instead of shuffling both
    sides, and many small parts are read together. It stays until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
