"""Where jobs may leave files for other jobs."""

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, named by ``spark.checkpoint.dir``.

    Where that is unset, the folder that the session's owner gave to ``setCheckpointDir``.
    There is no other fallback: a folder of one machine would lose files on a cluster.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return shared.rstrip("/")


def fresh_output_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. Whoever asked for it may delete what is written there."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
