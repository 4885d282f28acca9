"""Where jobs put files: a fresh folder per run under the storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only local sessions without one get a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="lakekit-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """Path of a new, not yet existing folder for one run of a job."""
    return f"{shared_root(spark)}/lakekit/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows stored in the shared folder and read back: cuts the lineage, and Spark then knows how large they are."""
    path = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def use_checkpoints(spark: SparkSession) -> None:
    """Make DataFrame.checkpoint() usable."""
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)


def nothing_stored(error: AnalysisException) -> bool:
    """Whether a read failed because the folder is missing or empty; any other failure is a real one."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
