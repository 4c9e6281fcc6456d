"""Pair each return with the sale it belongs to.

Four tables take part. *moves* pairs the inventory origin of a sold line with
that of its return; *link* lists the sale origins that have a return, with the
statement the return was posted in; *origins* resolves an inventory origin to
its sales order; *headers* resolves a sales order to shop transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeload.operators.skew import hot_keys, lookup_join
from lakeload.operators.versioned import latest_version


def return_lineage(link: DataFrame, moves: DataFrame, origins: DataFrame, headers: DataFrame) -> DataFrame:
    """One row per linked (sale origin, return origin) and transaction of the return's order.

    Inputs (other columns are ignored):
      link     INVENTTRANSORIGIN, SALESIDRETURN
      moves    INVENTTRANSORIGIN, RETURNINVENTTRANSORIGIN
      origins  RECID, REFERENCEID
      headers  SALESORDERID, TRANSACTIONID, TRANSDATE, STATEMENTID, RETURNTRANSACTIONID

    The return origin is taken from *moves*: the one in *link* need not
    resolve. The sale is the transaction of the sale's order that the return
    names in RETURNTRANSACTIONID; a return that names none of them gets the
    order's latest. Both are lookups by key, so the output grows with the
    return transactions, however many an order has. Headers that repeat an
    order and transaction count by the latest.
    Flags: the return names the sale's transaction; the return's statement is
    the one its link lists.
    """
    sale, ret = "sale_origin", "return_origin"
    moves = _present(moves, "INVENTTRANSORIGIN", "RETURNINVENTTRANSORIGIN")
    moves = _renamed(moves, INVENTTRANSORIGIN=sale, RETURNINVENTTRANSORIGIN=ret)
    origins = _present(origins, "RECID", "REFERENCEID").select("RECID", "REFERENCEID")
    link = _present(link, "INVENTTRANSORIGIN")
    headers = latest_version(
        _present(headers, "SALESORDERID").select("SALESORDERID", "TRANSACTIONID", "TRANSDATE", "STATEMENTID", "RETURNTRANSACTIONID"),
        ["SALESORDERID", "TRANSACTIONID"],
        ["TRANSDATE"],
        ["STATEMENTID", "RETURNTRANSACTIONID"],
    )

    # hot keys are sketched on the inputs, not on joined intermediates, which
    # would be computed once more for it
    hot_sale, hot_return = hot_keys(moves, [sale], [ret])
    hot_end = {h: max(hot_sale.get(h, 1), hot_return.get(h, 1)) for h in {*hot_sale, *hot_return}}
    (hot_order,) = hot_keys(origins, ["REFERENCEID"])

    linked = _renamed(link, INVENTTRANSORIGIN=sale).distinct()
    pairs = lookup_join(moves.distinct(), linked, [sale], "inner", hot_sale)
    # both ends of a pair as rows of one column, so that origins are read and
    # joined once, not once per end
    ends = pairs.withColumn("RECID", F.explode(F.array(sale, ret)))
    orders = origins.groupBy("RECID").agg(F.max("REFERENCEID").alias("order"))
    ends = lookup_join(ends, orders, ["RECID"], "inner", hot_end)

    def order_of(origin: str) -> Column:
        return F.max(F.when(F.col("RECID") == F.col(origin), F.col("order")))

    both = ends.groupBy(sale, ret).agg(order_of(sale).alias("sale_order"), order_of(ret).alias("return_order"))
    both = both.where("sale_order IS NOT NULL AND return_order IS NOT NULL")

    returns = _renamed(
        headers,
        SALESORDERID="return_order",
        TRANSACTIONID="return_transaction",
        TRANSDATE="return_date",
        STATEMENTID="return_statement",
        RETURNTRANSACTIONID="named",
    )
    both = lookup_join(both, returns, ["return_order"], "inner", hot_order)

    latest = latest_version(headers, ["SALESORDERID"], ["TRANSDATE"], ["TRANSACTIONID"])
    latest = _renamed(latest, SALESORDERID="sale_order", TRANSACTIONID="latest_transaction", TRANSDATE="latest_date")
    both = lookup_join(both, latest, ["sale_order"], "inner", hot_order)

    by_id = _renamed(_present(headers, "TRANSACTIONID"), SALESORDERID="sale_order", TRANSACTIONID="named", TRANSDATE="named_date")
    by_id = by_id.withColumn("names_sale", F.lit(True))
    both = lookup_join(both, by_id, ["sale_order", "named"], "left", hot_order, hot_on=["sale_order"])

    listed = _renamed(_present(link, "SALESIDRETURN"), INVENTTRANSORIGIN=sale, SALESIDRETURN="return_statement")
    listed = listed.distinct().withColumn("listed", F.lit(True))
    both = lookup_join(both, listed, [sale, "return_statement"], "left", hot_sale, hot_on=[sale])
    return both.select(
        sale,
        ret,
        "sale_order",
        F.when(F.col("names_sale"), F.col("named")).otherwise(F.col("latest_transaction")).alias("sale_transaction"),
        F.when(F.col("names_sale"), F.col("named_date")).otherwise(F.col("latest_date")).alias("sale_date"),
        "return_order",
        "return_transaction",
        "return_date",
        F.coalesce("names_sale", F.lit(False)).alias("names_sale"),
        F.coalesce("listed", F.lit(False)).alias("statement_matches"),
    )


def _renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*(F.col(old).alias(new) for old, new in names.items()))


def _present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with an id in every column; conformed text ids are empty, not NULL."""

    def given(c: str) -> Column:
        is_text = df.schema[c].dataType.typeName() == "string"
        return F.col(c).isNotNull() & (F.col(c) != "") if is_text else F.col(c).isNotNull()

    keep = given(columns[0])
    for c in columns[1:]:
        keep &= given(c)
    return df.where(keep)
