"""Contracts and derived inputs over the sample tables, used by the registered queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeload.contracts import TableContract, contract_from_description
from lakeload.sources.files import read_landed

FIRST_LOAD = datetime(2024, 3, 1, 6, 0, 0)
SECOND_LOAD = datetime(2024, 3, 2, 6, 0, 0)

_BOOKKEEPING = [("last_synced_at", "DateTime", "", ""), ("updated_at", "DateTime", "DEFAULT", "now()")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_landed(spark, f"{sf_dir}/{name}.parquet")


def _contract(name: str, columns: list[tuple[str, str]], **facts: object) -> TableContract:
    return contract_from_description(name, [*((c, t, "", "") for c, t in columns), *_BOOKKEEPING], **facts)


EVENTS = _contract(
    "events",
    [
        ("event_id", "UInt64"),
        ("ts", "DateTime"),
        ("user_id", "Int64"),
        ("event_type", "String"),
        ("value", "Float64"),
        ("props", "String"),
    ],
    primary_key="event_id",
    date_column="ts",
    modified_column="ts",
)

ORDERS = _contract(
    "orders",
    [
        ("o_orderkey", "UInt64"),
        ("o_custkey", "Int64"),
        ("o_orderstatus", "String"),
        ("o_totalprice", "Float64"),
        ("o_orderdate", "DateTime"),
        ("o_orderpriority", "String"),
    ],
    primary_key="o_orderkey",
    date_column="o_orderdate",
    modified_column="o_orderdate",
)


def stamped(df: DataFrame, contract: TableContract, as_of: datetime) -> DataFrame:
    """Rows already of the contract's types, given their bookkeeping columns."""
    marks = {
        contract.synced_column: F.lit(None).cast("timestamp_ntz"),
        contract.version_column: F.lit(str(as_of)).cast("timestamp_ntz"),
    }
    return df.withColumns(marks).select(*contract.schema.names)


def order_changes(orders: DataFrame) -> DataFrame:
    """All orders as a change batch: finished ones were modified a day later."""
    later = F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")
    return orders.withColumn("o_orderdate", F.when(F.col("o_orderstatus") == "F", later).otherwise(F.col("o_orderdate")))


def orders_before_2000(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


def return_links(lineitem: DataFrame) -> DataFrame:
    """Returned lines (``ret``) and the sold line (``sale``) each is linked to.

    A return belongs to the latest line of the same part and supplier that was
    sold on an earlier day in another order; of one day's lines, to the greatest
    order and line. A day's two greatest orders suffice to find one that differs
    from the return's, so only a row per day is carried forward, and returns
    look it up by their day: linear, however many lines a part has.
    """
    pair = ["l_partkey", "l_suppkey"]
    lines = lineitem.where("l_returnflag IN ('N', 'R')").select(
        *pair,
        F.to_date("l_shipdate").alias("on"),
        "l_returnflag",
        F.struct(
            F.col("l_shipdate").alias("day"),
            F.col("l_orderkey").alias("order"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        ).alias("line"),
    )
    sold = F.max(F.when(F.col("l_returnflag") == "N", F.col("line")))
    by_order = lines.groupBy(*pair, "on", F.col("line.order").alias("of")).agg(sold.alias("sale"))
    rank = F.row_number().over(Window.partitionBy(*pair, "on").orderBy(F.desc_nulls_last("sale")))
    two = by_order.withColumn("rank", rank).where("rank <= 2").groupBy(*pair, "on")
    days = two.agg(F.max("sale").alias("first"), F.max(F.when(F.col("rank") == 2, F.col("sale"))).alias("second"))
    # the latest sale before a day, and the latest one of another order than that
    before = Window.partitionBy(*pair).orderBy("on").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("last", F.max("first").over(before))
    upto = Window.partitionBy(*pair).orderBy("on").rowsBetween(Window.unboundedPreceding, 0)
    # where the last sale's order changes, the one before is the other
    days = days.withColumn("other_here", F.when(F.col("second").isNotNull(), F.col("second")).when(F.col("first")["order"] != F.col("last")["order"], F.col("last")))
    days = days.withColumn("other_upto", F.last("other_here", ignorenulls=True).over(upto))
    days = days.withColumn("other", F.lag("other_upto").over(Window.partitionBy(*pair).orderBy("on")))
    returned = lines.where("l_returnflag = 'R'").select(*pair, "on", F.col("line").alias("ret"))
    linked = returned.join(days.select(*pair, "on", "last", "other"), [*pair, "on"])
    sale = F.when(F.col("last")["order"] != F.col("ret")["order"], F.col("last")).otherwise(F.col("other"))
    return linked.select(sale.alias("sale"), "ret").where("sale IS NOT NULL")


def return_tables(lineitem: DataFrame, orders: DataFrame, links: DataFrame) -> dict[str, DataFrame]:
    """The four lineage inputs: link, moves, origins and headers.

    A return names the greatest of its order's sales. Finished orders have a
    second transaction a day later, which names nothing.
    """
    named = links.groupBy(F.col("ret.order").alias("o_orderkey")).agg(F.max("sale.order").alias("named"))
    closed = F.when(F.col("o_orderstatus") == "P", "ST-open").otherwise(F.concat(F.lit("ST-"), F.col("o_orderkey")))
    again = F.explode(F.when(F.col("o_orderstatus") == "F", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    headers = orders.join(named, "o_orderkey", "left").withColumn("again", again)
    return {
        "link": links.select(
            F.col("sale.id").alias("INVENTTRANSORIGIN"), F.concat(F.lit("ST-"), "ret.order").alias("SALESIDRETURN")
        ),
        "moves": links.select(
            F.col("sale.id").alias("INVENTTRANSORIGIN"), F.col("ret.id").alias("RETURNINVENTTRANSORIGIN")
        ),
        "origins": lineitem.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("RECID"),
            F.concat(F.lit("SO-"), "l_orderkey").alias("REFERENCEID"),
        ),
        "headers": headers.select(
            F.concat(F.lit("SO-"), "o_orderkey").alias("SALESORDERID"),
            F.concat(F.lit("T-"), "o_orderkey", F.when(F.col("again") == 1, "-2").otherwise("")).alias("TRANSACTIONID"),
            (F.col("o_orderdate") + F.col("again") * F.expr("INTERVAL 1 DAY")).alias("TRANSDATE"),
            closed.alias("STATEMENTID"),
            F.when(F.col("again") == 0, F.concat(F.lit("T-"), "named")).alias("RETURNTRANSACTIONID"),
        ),
    }
