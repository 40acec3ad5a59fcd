"""Session settings and the shared staging folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores="*", shuffle_partitions=8, app_name="ratinglens") -> SparkSession:
    """Session for tests and the benchmark; on a cluster the submitter's settings apply instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_path(spark: SparkSession, label: str) -> str:
    """New path for a staged table below the folder named by ``spark.checkpoint.dir``.

    All executors must see that folder. Only a local session may go without the setting; it gets a
    temporary folder, which it shares with its own threads.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ratinglens-")
        spark.conf.set(CHECKPOINT_SETTING, folder)
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"
