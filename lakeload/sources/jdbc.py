"""Operational database tables over JDBC.

Credentials belong in ``options`` from the caller's secret store, never here.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from lakeload.operators.incremental import date_between

# Fixed value: the statement size used for inserts into the warehouse.
INSERT_BATCH = 10_000


def table_query(table: str, dirty_read: bool = False) -> str:
    """All columns of a table as a sub-select; a reader has no isolation option, so the hint goes inside."""
    hint = " WITH (NOLOCK)" if dirty_read else ""
    return f"(SELECT * FROM {table}{hint}) src"


def snapshot(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    dirty_read: bool = False,
) -> DataFrame:
    """A whole table, read in ``partitions`` concurrent key ranges.

    ``bounds`` only shape the ranges; rows outside them are read too. Take
    them from the database's own statistics or an indexed min/max.
    """
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", table_query(table, dirty_read))
        .option("partitionColumn", key)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", str(partitions))
        .load()
    )


def day_predicates(column: str, first: date, last: date) -> list[str]:
    """One half-open range per day, together exactly the days ``first`` to ``last``."""
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    return [f"{column} >= '{d}' AND {column} < '{d + timedelta(days=1)}'" for d in days]


def date_range(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    table: str,
    column: str,
    first: date,
    last: date,
    dirty_read: bool = False,
) -> DataFrame:
    """Rows dated ``first`` to ``last``, both inclusive, one concurrent read per day.

    Ranges on the bare column let the database use its index, which a
    comparison on the cast date would not.
    """
    return spark.read.jdbc(
        url,
        table_query(table, dirty_read),
        predicates=day_predicates(column, first, last),
        properties=dict(properties),
    )


def insert(df: DataFrame, options: Mapping[str, str], table: str, batch: int = INSERT_BATCH) -> None:
    """Typed insert into a database table, each task sending ``batch`` rows a statement."""
    df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", str(batch)).mode("append").save()
