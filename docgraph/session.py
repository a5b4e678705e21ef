"""Session settings, and the shared folder in which long computations cut their lineage.

A session that a cluster provides needs none of the settings.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[8]", partitions: int = 8, **settings: str) -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    } | settings
    return SparkSession.builder.master(master).appName("docgraph").config(map=conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir where it is set.

    Only where it is unset and the master is local, as in tests, a temporary folder of this machine is taken instead.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="docgraph-"))
    return named or context._jsc.sc().getCheckpointDir().get()


def run_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/docgraph-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder's path below this application's."""
    return f"{run_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def sweep(spark: SparkSession) -> None:
    """Removes this application's folder. Results that were written elsewhere stay; DataFrames that aren't yet computed
    may still read from the folder, so this is for the end of a run."""
    where = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder. For loops: unlike a checkpoint's, its size is known to the planner, while
    estimates of joined checkpoints multiply round by round."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: lineage ends in files that every executor can read."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
