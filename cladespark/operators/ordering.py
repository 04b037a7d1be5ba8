"""Total orders without one task that holds all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Rows for each range from which the bounds of ranges of texts are taken.
SAMPLED = 64


def numbered_in_order(df: DataFrame, by: list[str], parts: int | None = None) -> DataFrame:
    """Adds k, the place of each row from 1 in the order of ``by``.

    Rows are dealt into ranges of the first column, by quantiles; each range numbers its own rows and adds the sizes of the
    ranges before it, which are few.
    """
    spark = df.sparkSession
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = by[0]
    kind = df.schema[first].dataType.simpleString()
    if kind in ("string", "boolean", "date", "timestamp"):
        sample = df.filter(F.col(first).isNotNull()).select(first, F.xxhash64(*by).alias("h")).orderBy("h", first).limit(SAMPLED * count)
        seen = sorted(r[0] for r in sample.collect())  # SAMPLED rows for each range
        bounds = sorted({*seen[SAMPLED // 2 :: SAMPLED]})
    else:
        found = df.agg(F.percentile_approx(first, [i / count for i in range(1, count)] or [0.5])).first()[0] or []
        bounds = sorted({*found})
    part = reduce(lambda a, b: a + (F.col(first) > F.lit(b)).cast("int"), bounds, F.lit(0))
    placed = df.withColumn("_part", F.coalesce(part, F.lit(-1)))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row for each range
    ranked = placed.withColumn("_k", F.row_number().over(Window.partitionBy("_part").orderBy(*by)))
    return ranked.join(F.broadcast(before), "_part").withColumn("k", (F.col("_k") + F.col("_before")).cast("long")).drop("_part", "_k", "_before")
