"""What several of these operators need."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`. Only a local session without that setting, as in tests, gets a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor sees")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the checkpoint folder, where every executor finds them.

    Spark removes the files when nothing refers to them any more, if `spark.cleaner.referenceTracking.cleanCheckpoints`
    is on.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def remainder(column: str, by: int) -> Column:
    """crc32 of an id written as text, modulo a number; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string")) % by


def row_key(id: str, text: str) -> Column:
    """The same for rows with the same id and text, NULL like an empty text, and different for all others."""
    number = F.col(id).cast("string")
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return F.md5(F.concat_ws(":", number.isNull().cast("string"), F.coalesce(number, F.lit("")), digest))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as Parquet to a new folder in that of the checkpoints and read again.

    The folder goes with the Python process, as checkpoints do.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
