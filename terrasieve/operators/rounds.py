"""What operators that go on in rounds share, and where they and round trips keep things."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new name in the folder that all executors share, `spark.checkpoint.dir`; only a local session may go without it."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    path = f"{where.rstrip('/')}/{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    try:  # at exit the session may be gone already
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001
        pass


def settled(df: DataFrame) -> DataFrame:
    """`df` without the plans of earlier rounds, which would else be planned and run again each round: written to the shared
    folder, and read from there until the driver ends. A lost executor costs a reread only.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
