"""The shared folder for files a job writes on its way."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from cdcframe.files import Files


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this name under `spark.checkpoint.dir`.

    It goes away with the process, unless the session has been stopped by then. Where that is not set, as in tests, a local session gets a temporary folder that goes away with the
    process. On a cluster there is no folder that all machines see, so that is an error.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        folder = f"{shared.rstrip('/')}/cdcframe-{name}-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor sees")
    folder = tempfile.mkdtemp(prefix=f"cdcframe-{name}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        Files(spark, folder).delete(folder)
