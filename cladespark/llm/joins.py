"""Joining rows with a table that has one row for each of their groups, one of which may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups that are broadcast; more are joined by a shuffle in which each group is dealt over so many tasks.
BROADCAST_GROUPS, SALTS = 100_000, 64


def attached(rows: DataFrame, groups: DataFrame, own: str, group: str) -> DataFrame:
    """``rows`` with the columns of the group whose ``group`` equals their ``own`` (null equals null), without ``group``."""
    if groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), F.col(own).eqNullSafe(F.col(group))).drop(group)
    salted = groups.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, F.col(own).eqNullSafe(F.col(group)) & (F.col("_salt") == F.col("_at"))).drop(group, "_at", "_salt")
