"""Sessions, tables and places shared by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", app: str = "spanloom") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Only a local master, whose executors are on this machine, gets a temporary one where it is
    unset; on a cluster that raises ValueError.
    """
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not told:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        told = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(told)
    return told.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """The folder of this application's written tables below the shared one."""
    return f"{shared_dir(spark)}/spanloom-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> bool:
    """Delete the tables that this application wrote; frames that read them can't be used any more. True if there were any."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once as a table in the shared folder and read it back.

    Cuts the lineage so that costly work runs once, survives the loss of executors, and
    gives later joins the true size of the data. release deletes the tables of an application.
    """
    return materialize_counted(df, name)[0]


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The same, and the number of rows, counted while they are written."""
    spark, counted = df.sparkSession, Observation()
    where = os.path.join(scratch(spark), f"{name}-{uuid.uuid4().hex}")
    df.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(where)
    return spark.read.schema(df.schema).parquet(where), int(counted.get.get("n") or 0)
