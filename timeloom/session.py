"""Session helpers.

Library code never builds its own session; it works on the one it is given.
``get_session`` is for scripts and tests only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. AQE re-plans joins (broadcast when a side
# turns out small at run time) and splits skewed shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, partitions: int | None = None,
                app: str = "timeloom") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", os.environ.get("TIMELOOM_DRIVER_MEM", "16g"))
         .config("spark.sql.shuffle.partitions", str(partitions or 8)))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is used as is; a cluster
    session without it is an error, because a folder of the driver's machine is
    not seen by the executors. Only in local mode (tests, where driver and
    executors are one process) a scratch folder is made and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="timeloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives lost
    executors, unlike a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Cuts the lineage like a checkpoint, but readers get a columnar scan with
    column pruning, pushed filters and partition pruning. Each call writes a
    path of its own, so concurrent or repeated runs never mix."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    out = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    out._stage_path = path
    return out


def release(*stages: DataFrame) -> None:
    """Remove the files of stage tables that nothing will read again: call it
    once all that was derived from them is written."""
    for df in stages:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stage_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
