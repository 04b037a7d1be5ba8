"""Depth figures that follow arriving files, with the same sums as the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "sample string, target string, depth long"
STATS = "sample string, targets_total long, targets_with_min_reads long"
#: Names of versions: folders of files, and the marks that say that they are whole.
FOLDER, MARK = "version-", "_whole-"


def arriving_depth(spark: SparkSession, folder: str, files_at_once: int = 100) -> DataFrame:
    """Rows of depth files (Parquet with sample, target, depth) as they come into a folder."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def running_stats(depth: DataFrame, min_reads: int = 10) -> DataFrame:
    """sample, targets_total, targets_with_min_reads so far."""
    return depth.groupBy("sample").agg(F.count(F.lit(1)).alias("targets_total"), F.count_if(F.col("depth") >= min_reads).alias("targets_with_min_reads"))


def start(stats: DataFrame, path: str, checkpoint: str, name: str = "depth_stats", keep: int = 3, once: bool = False) -> StreamingQuery:
    """Writes the complete table as a new version after each arrival; the state survives a restart. once: ends when what is there is read.

    A version is a folder of its own, named by its batch, and counts from when its mark is there, which is made when all its files are: readers
    (``current``) always see a whole table. A batch that is run again after a failure writes its version anew, with the same
    rows. The last ``keep`` versions stay for readers that have begun.
    """

    def add(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(f"{path}/{FOLDER}{batch:012d}")
        fs, folder = file_system(spark, path)
        at = lambda name: spark._jvm.org.apache.hadoop.fs.Path(folder, name)
        fs.create(at(f"{MARK}{batch:012d}"), True).close()
        done = versions(spark, path)
        for old in done[: max(0, len(done) - keep)]:  # its mark goes first, so that nobody begins to read it
            fs.delete(at(f"{MARK}{old:012d}"), False)
            fs.delete(at(f"{FOLDER}{old:012d}"), True)

    writer = stats.writeStream.outputMode("complete").queryName(name).option("checkpointLocation", checkpoint).foreachBatch(add)
    return (writer.trigger(availableNow=True) if once else writer).start()


def file_system(spark: SparkSession, path: str):  # noqa: ANN201
    """Hadoop's file system of a path, and the path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, path: str) -> list[int]:
    """Batches whose versions are whole, in order."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n.removeprefix(MARK)) for n in names if n.startswith(MARK))


def current(spark: SparkSession, path: str, schema: str = STATS) -> DataFrame:
    """The last whole version; no rows before the first."""
    done = versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/{FOLDER}{done[-1]:012d}") if done else spark.createDataFrame([], schema)
