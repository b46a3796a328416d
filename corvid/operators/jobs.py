"""Multi-step jobs composed from the operator families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators.ordering import top_k


def net_revenue(price: str = "l_extendedprice", discount: str = "l_discount"):
    return F.col(price) * (1 - F.col(discount))


def top_customers_by_revenue(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                             nation: DataFrame, k: int = 10) -> DataFrame:
    """Customers with the highest net revenue, with name and nation.

    Plan: lineitem is pre-aggregated to one row per order (partial aggregation before the
    shuffle), joined to orders on the order key, re-aggregated per customer, cut to the
    top ``k`` (TakeOrderedAndProject, no global sort), and only then joined to the
    customer and nation dimensions.
    """
    per_order = (lineitem.groupBy("l_orderkey")
                 .agg(F.sum(net_revenue()).alias("order_revenue")))
    per_customer = (orders.select("o_orderkey", "o_custkey")
                    .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
                    .groupBy(F.col("o_custkey").alias("c_custkey"))
                    .agg(F.round(F.sum("order_revenue"), 4).alias("revenue"),
                         F.count("*").alias("n_orders")))
    best = top_k(per_customer, k, [F.col("revenue").desc(), F.col("c_custkey").asc()])
    # The customer dimension is streamed once through a broadcast semi-join against the k
    # winning keys (build side bounded by k), so it is never shuffled; the outer join that
    # keeps all k rows then only sees <= k customers.
    named = (customer.select("c_custkey", "c_name", "c_nationkey")
             .join(F.broadcast(best.select("c_custkey")), "c_custkey", "left_semi")
             .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    return (best.join(named, "c_custkey", "left")
            .select("c_custkey", "c_name", "n_name", "revenue", "n_orders"))


SALES_COLUMNS = ["Order ID", "Product", "Quantity Ordered", "Price Each", "Order Date", "Purchase Address"]


def sales_lines(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame,
                region: DataFrame) -> DataFrame:
    """Sales-order lines shaped like monthly sales CSV exports: text date ``MM/dd/yy HH:mm``
    and a ``"<n> Main St, <city>, <state> 00000"`` address; pending orders lack the quantity."""
    addr = F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St, "), F.col("n_name"), F.lit(", "),
                    F.col("r_name"), F.lit(" 00000"))
    geo = (customer.select("c_custkey", "c_nationkey")
           .join(nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
           .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("c_custkey", addr.alias("address")))
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    lines = (lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
             .join(o, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(geo, F.col("o_custkey") == F.col("c_custkey")))
    qty = F.when(F.col("o_orderstatus") != "P", F.col("l_quantity").cast("int"))
    return lines.select(F.col("l_orderkey").cast("string").alias("Order ID"),
                        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("Product"),
                        qty.cast("string").alias("Quantity Ordered"),
                        (F.col("l_extendedprice") / F.col("l_quantity")).cast("string").alias("Price Each"),
                        F.date_format("o_orderdate", "MM/dd/yy HH:mm").alias("Order Date"),
                        F.col("address").alias("Purchase Address"))


def clean_sales(raw: DataFrame) -> DataFrame:
    """Sales clean-up: columns renamed without blanks, repeated header rows and rows with
    NULLs removed, city/state split from the address, order time parsed, month/year added."""
    from corvid.functions.parse import to_ts_two_digit_year
    from corvid.operators.shape import drop_null_rows, drop_repeated_headers, rename_all, without_blanks
    no_headers = drop_repeated_headers(raw, {c: c for c in SALES_COLUMNS})
    renamed = rename_all(no_headers, without_blanks)
    typed = renamed.select(
        F.col("OrderID").try_cast("int").alias("OrderID"), "Product",
        F.col("QuantityOrdered").try_cast("int").alias("QuantityOrdered"),
        F.col("PriceEach").try_cast("double").alias("PriceEach"),
        to_ts_two_digit_year("OrderDate", "MM/dd/yy HH:mm").alias("OrderDate"), "PurchaseAddress")
    clean = drop_null_rows(typed, "any")
    parts = F.split("PurchaseAddress", ", ")
    return (clean.withColumn("City", F.trim(F.get(parts, 1)))
            .withColumn("State", F.get(F.split(F.trim(F.get(parts, 2)), " "), 0))
            .withColumn("Month", F.month("OrderDate")).withColumn("Year", F.year("OrderDate")))
