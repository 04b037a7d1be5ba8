"""Lineage and methylation analytics on Spark DataFrames."""

from __future__ import annotations

import os
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from pyspark.sql import SparkSession

__version__ = "0.1.0"


def reach_workers(spark: SparkSession) -> None:
    """Puts this package's folder on the path of Python workers, for where it isn't installed.

    Where executors don't have that folder, ship the package with --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])
