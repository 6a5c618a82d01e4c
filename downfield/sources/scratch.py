"""Tables that are written to cut a lineage: a lost executor then costs a read and no recomputation."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only a session in one process may do without the setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = f"{tempfile.gettempdir()}/downfield-scratch"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder and read again."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Deletes the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
