"""The line-item fact: order lines joined to their order, payment, customer,
product and seller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.operators.sizing import BROADCAST_BYTES, looked_up
from shopscope.schemas import FACT_COLUMNS


def build_fact(orders: DataFrame, items: DataFrame, payments: DataFrame, customers: DataFrame,
               products: DataFrame, sellers: DataFrame,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left joins from the order lines; every line is kept exactly once.

    Join order is chosen for the shuffle cost, not copied from the table list:
    customers are joined to the orders and products and sellers to the narrow
    items, and then all of them meet on ``order_id``. Customers, products and
    sellers are broadcast when their bytes are within ``broadcast_bytes``; of a
    larger one only (order, id) pairs are shuffled (``looked_up``), never the
    lines. Where the tables are bucketed on ``order_id``, nothing else is.
    """
    orders_c = looked_up(orders, customers, "customer_id", "order_id", broadcast_bytes)
    lines = looked_up(items, sellers, "seller_id", "order_id", broadcast_bytes)
    lines = looked_up(lines, products, "product_id", "order_id", broadcast_bytes)
    fact = lines.join(orders_c, "order_id", "left").join(payments, "order_id", "left")
    fact = fact.withColumns({
        "revenue": F.col("price"),
        "total_order_value": F.coalesce(F.col("total_payment"), F.col("total_item_revenue")),
    })
    return fact.select(*FACT_COLUMNS)
