"""Tables between jobs, in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from otelier.session import scratch_path


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the folder in `spark.checkpoint.dir` and read it back: later jobs start from files that outlive
    executors, and a plan used more than once is computed once."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
