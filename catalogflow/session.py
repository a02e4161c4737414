"""Session set-up shared by the bench, the tests and the driver entry."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "catalogflow", cpus: int = 8, **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # Expressions here have many nodes; PySpark would record the call site of each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    the setting gets a temporary folder; on a cluster a missing setting is an error,
    since a folder of one machine is of no use to the others.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(configured)
        return configured
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is stored once and survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The result as parquet in the shared folder: smaller than a checkpoint and read by column. The shuffle files of the write go when it ends."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = f"{shared_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}", spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)
