"""The scheduled jobs of the retail tables, for ``spark-submit``.

    jobs.py land TABLE --lake URI --options FILE --source dbo.TABLE [--key K] --bounds LO HI --partitions N
    jobs.py land TABLE --lake URI --options FILE --source dbo.TABLE --column C --days FIRST LAST
    jobs.py daily|monthly|full TABLE --lake URI --warehouse URI --description FILE

``--options`` is a JSON object of JDBC reader options, credentials included,
kept outside the repository. ``--description`` is the warehouse's description
of the table: a JSON list of [name, type, default kind, default text].
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from lakeload.contracts import landed_path, retail_contract
from lakeload.plans.load import MODES, LoadReport, run_load
from lakeload.sources import files, jdbc
from lakeload.tables import MonthTable


def land(df: DataFrame, lake: str, table: str, append: bool) -> str:
    """Write source rows to the table's place in the lake, replacing it or adding to it."""
    path = landed_path(lake, table)
    if append:
        files.append_parquet(df, path)
    else:
        files.write_snapshot(df, path)
    return path


def load(
    spark: SparkSession,
    table: str,
    mode: str,
    lake: str,
    warehouse: str,
    description: Sequence[Sequence[str]],
    as_of: datetime | None = None,
) -> LoadReport:
    """Load one landed retail table; rejects and audit lie next to the warehouse tables."""
    root = warehouse.rstrip("/")
    target = MonthTable(spark, f"{root}/{table}", retail_contract(table, description))
    source = files.read_landed(spark, landed_path(lake, table))
    return run_load(source, target, mode, as_of, f"{root}/rejects/{table}", f"{root}/etl_runs/{table}")


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["land", *MODES])
    parser.add_argument("table")
    parser.add_argument("--lake", required=True)
    parser.add_argument("--warehouse")
    parser.add_argument("--description")
    parser.add_argument("--options")
    parser.add_argument("--source")
    parser.add_argument("--key", default="RECID")
    parser.add_argument("--bounds", nargs=2, type=int)
    parser.add_argument("--partitions", type=int)
    parser.add_argument("--column")
    parser.add_argument("--days", nargs=2, type=date.fromisoformat)
    given = parser.parse_args(arguments)

    needed = ["options", "source"] if given.job == "land" else ["warehouse", "description"]
    absent = [f"--{name}" for name in needed if getattr(given, name) is None]
    if absent:
        parser.error(f"{given.job} needs {', '.join(absent)}")
    if (given.days is None) != (given.column is None):
        parser.error("--days and --column go together")
    if given.job == "land" and given.days is None and (given.bounds is None or given.partitions is None):
        parser.error("a snapshot needs --bounds and --partitions: one read would put the table in one task")

    spark = SparkSession.builder.appName(f"{given.job} {given.table}").getOrCreate()
    if given.job != "land":
        with open(given.description, encoding="utf-8") as f:
            print(load(spark, given.table, given.job, given.lake, given.warehouse, json.load(f)))
        return
    with open(given.options, encoding="utf-8") as f:
        options = json.load(f)
    if given.days is None:
        df = jdbc.snapshot(
            spark, options, given.source, given.key, tuple(given.bounds), given.partitions, dirty_read=True
        )
    else:
        url = options.pop("url")
        df = jdbc.date_range(spark, url, options, given.source, given.column, *given.days, dirty_read=True)
    print(land(df, given.lake, given.table, append=given.days is not None))


if __name__ == "__main__":
    main()
