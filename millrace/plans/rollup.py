"""Sales rollup by customer, item, year and month, kept up to date by additive merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import merge

KEYS = ["CustomerID", "StockItemID", "SalesMonth", "SalesYear"]
MEASURES = ["Quantity", "TotalItemSale"]
MONEY = "decimal(19,4)"


def sales_rollup(lines: DataFrame, orders: DataFrame, customers: DataFrame, items: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``sum(q)`` and ``sum(q*p + q*p*(tax/100))`` per customer, item and month.

    ``lines(OrderID, StockItemID, Quantity, Price, TaxRate)`` with Price the line
    price ``q*p``; ``orders(OrderID, CustomerID, OrderDate)``. Only the order join
    moves all lines; the customer and item checks run on the grouped rows, because
    their keys are group keys. Columns of the orders named in ``by`` are group
    keys too, so that several rollups move the lines once.
    """
    keys = [*KEYS, *(by or [])]
    sale = F.col("Price") + F.col("Price") * (F.col("TaxRate") / F.lit(100).cast("decimal(3,0)"))
    priced = lines.select("OrderID", "StockItemID", "Quantity", sale.alias("TotalItemSale"))
    dated = orders.select(
        "OrderID", "CustomerID", F.month("OrderDate").alias("SalesMonth"), F.year("OrderDate").alias("SalesYear"), *(by or [])
    )
    joined = priced.join(dated, "OrderID")
    grouped = joined.groupBy(*keys).agg(
        F.sum("Quantity").alias("Quantity"), F.sum("TotalItemSale").cast(MONEY).alias("TotalItemSale")
    )
    known = grouped.join(customers.select("CustomerID"), "CustomerID", "left_semi")
    return known.join(items.select("StockItemID"), "StockItemID", "left_semi").select(*keys, *MEASURES)


def merge_rollup(target: DataFrame, delta: DataFrame) -> DataFrame:
    """Known keys add quantity and sale, new keys are inserted."""
    return merge.merge_additive(target, delta, KEYS, MEASURES)


def changed_orders(new_lines: DataFrame, old_lines: DataFrame) -> DataFrame:
    """Orders with a line whose quantity, price or tax really changed."""
    columns = ["OrderID", "Quantity", "Price", "TaxRate"]
    return merge.changed_rows(new_lines, old_lines, columns).select("OrderID").distinct()
