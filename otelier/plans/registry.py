"""The table of queries: name -> Spark plan, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from otelier.functions.anyvalue import any_value, last_value
from otelier.functions.expressions import column, hex_id
from otelier.plans.oracle import with_tables
from otelier.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *tables: str):
    """Register a plan `(spark, sf) -> DataFrame`; `sql` over `tables` gives the same rows."""

    def register(plan: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return plan(configure(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql, *tables) if tables else sql.strip()
        return plan

    return register


# ---------------------------------------------------------------- result columns: scalars that SQL has too


def big(name: str, out: str | None = None) -> Column:
    return column(name).cast("bigint").alias(out or name)


def attribute(col: str, key: str, out: str) -> Column:
    return any_value(last_value(F.col(col), key)).alias(out)


def hexed(*names: str) -> list[Column]:
    return [hex_id(n).alias(n) for n in names]
