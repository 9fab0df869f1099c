"""Python workers must find this package."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

import otelier


def reachable(spark: SparkSession) -> SparkSession:
    """Put the folder that holds the package on the workers' module path, for a driver that found it by sys.path. On a
    cluster the package is installed or sent by --py-files; then this changes nothing."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(otelier.__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    # texts can be long: with fewer rows at a time workers stay small
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark
