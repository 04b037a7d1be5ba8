"""Tables that cut lineage, in the folder that the cluster shares.

The folder is the session's ``spark.checkpoint.dir``. Only where that is unset is a
folder below the session's warehouse, which executors share too, used in its place.
"""

from __future__ import annotations

import contextlib
import gc
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, which is also set as the checkpoint folder if none was."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


class Scratch:
    """Parquet tables of one job, below a folder of its own."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
        self.count = 0
        self.tables: list[str] = []

    def keep(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Writes ``df`` once and returns it as read from disk."""
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        df.write.parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_dealt(self, df: DataFrame, by: str, parts: int) -> DataFrame:
        """As ``keep``, dealt by a column into so many parts, which joins and groups by that column then read without a shuffle."""
        self.count += 1
        name = f"scratch_{uuid.uuid4().hex}"
        self.tables.append(name)
        df.write.format("parquet").option("compression", "zstd").bucketBy(parts, by).option("path", f"{self.root}/{self.count:03d}-{name}").saveAsTable(name)
        return self.spark.table(name)

    def free(self) -> None:
        """Lets go of shuffle files that only written tables needed: Spark removes them once the driver has collected its garbage.

        The driver's heap, which plans of many jobs fill, gets small again.
        """
        for _ in range(2):  # what goes first lets go of the rest
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.3)

    def drop(self) -> None:
        for name in self.tables:
            self.spark.sql(f"drop table if exists {name}")
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A Scratch whose tables go when the block ends: return a checkpoint() of the result."""
    tables = Scratch(spark)
    try:
        yield tables
    finally:
        tables.drop()
