"""Cutting the lineage of a DataFrame in the shared folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where it is unset a local session takes a temporary one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and stored in the shared folder; they survive the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written as Parquet in the shared folder; its file sizes tell Spark whether to broadcast it."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the files of a staged table that nothing reads any more. Only folders named by ``staged`` are touched."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if folder.rsplit("/", 1)[-1].startswith("staged-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
