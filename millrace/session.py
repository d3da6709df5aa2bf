"""Session helpers: a tuned local session, and tables that cut lineage in a shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", app: str = "millrace", partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset on a single machine (tests) a folder of
    this process is made, set and removed at exit; on a cluster, whose executors couldn't read it, it is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, at, True)
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


class Scratch:
    """Tables written to the shared folder so that later steps neither repeat nor depend on earlier
    ones: a lost executor costs only the tasks that ran on it. Parquet gives the readers true sizes,
    by which the planner chooses joins."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        path, fs = self._at(self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _at(self, where: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def cut(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return a DataFrame that reads it."""
        self._n += 1
        where = f"{self.root}/{self._n}"
        df.write.option("compression", "zstd").parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        out._millrace_path = where
        return out

    def drop(self, *dfs: DataFrame) -> None:
        """Remove tables that ``cut`` wrote and nothing reads any more."""
        for df in dfs:
            if where := getattr(df, "_millrace_path", None):
                path, fs = self._at(where)
                fs.delete(path, True)


def small(df: DataFrame, most_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast if it holds at most ``most_rows`` rows (counted); beyond that the
    planner joins by shuffle. Meant for tables that :class:`Scratch` wrote, where counting is cheap."""
    return F.broadcast(df) if df.count() <= most_rows else df
