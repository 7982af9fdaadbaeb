"""Top items per delivery city over recent orders (the flagship slice).

orders ⋈ items since T → SUM(quantity) per (city, item) → top k per city → table.

On the driver's TPC-H-like tables: city = customer nation name, item = ``l_partkey``,
quantity = ``l_quantity``, order time = ``o_orderdate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.marts import join_recent, sum_by, top_k_per

# parameters of the registered query (the data spans 1995-01-01 .. 2001-08-01)
NOW = "2001-08-01 00:00:00"
INTERVAL = "3 YEARS"
K = 20


def orders_view(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """order_id, delivery_city, created_at."""
    cust = customer.select("c_custkey", "c_nationkey")
    nat = nation.select(F.col("n_nationkey"), F.col("n_name").alias("delivery_city"))
    o = orders.select(F.col("o_orderkey").alias("order_id"), "o_custkey", F.col("o_orderdate").alias("created_at"))
    return (o.join(cust, o.o_custkey == cust.c_custkey)
             .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
             .select("order_id", "delivery_city", "created_at"))


def items_view(lineitem: DataFrame) -> DataFrame:
    """order_id, item_id, quantity (the product key, not the row key — see defect D5)."""
    return lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("item_id"),
                           F.col("l_quantity").alias("quantity"))


def top_items_per_city(orders: DataFrame, customer: DataFrame, nation: DataFrame, lineitem: DataFrame,
                       now: str = NOW, interval: str = INTERVAL, k: int = K) -> DataFrame:
    joined = join_recent(orders_view(orders, customer, nation), items_view(lineitem), "order_id",
                         "created_at", now, interval)
    sales = sum_by(joined, ["delivery_city", "item_id"], "quantity", "total_quantity_sold")
    ranked = top_k_per(sales, ["delivery_city"],
                       [F.col("total_quantity_sold").desc(), F.col("item_id").asc()], k, rank_col="rank")
    return ranked.select("delivery_city", "item_id", "total_quantity_sold", "rank")


def run_topk(spark, orders: DataFrame, customer: DataFrame, nation: DataFrame, lineitem: DataFrame, table: str,
             path: str | None = None, now: str = NOW, interval: str = INTERVAL, k: int = K) -> DataFrame:
    """The whole flow: recent orders ⋈ items → sums → top k per city → CREATE OR REPLACE table.

    One action (the write); a rerun replaces the table instead of appending to it.
    """
    from lakeloom.sources.sinks import replace_table

    return replace_table(top_items_per_city(orders, customer, nation, lineitem, now, interval, k), table, path)


ORACLE = f"""
WITH o AS (
  SELECT o.o_orderkey AS order_id, n.n_name AS delivery_city, o.o_orderdate AS created_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
), j AS (
  SELECT o.delivery_city, l.l_partkey AS item_id, l.l_quantity AS quantity
  FROM o JOIN lineitem l ON o.order_id = l.l_orderkey
  WHERE o.created_at >= TIMESTAMP '{NOW}' - INTERVAL 3 YEAR
), s AS (
  SELECT delivery_city, item_id, SUM(quantity) AS total_quantity_sold FROM j GROUP BY delivery_city, item_id
)
SELECT delivery_city, item_id, total_quantity_sold,
       ROW_NUMBER() OVER (PARTITION BY delivery_city ORDER BY total_quantity_sold DESC, item_id ASC) AS rank
FROM s
QUALIFY rank <= {K}
"""
