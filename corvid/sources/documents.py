"""Nested document tables (SRC-18): orders with their line items as ``array<struct>``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEM_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_returnflag", "l_shipdate"]


HEADER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def order_headers(orders: DataFrame) -> DataFrame:
    """The header fields of every document, one row per order: what a query that doesn't look
    into the items reads."""
    return orders.select(*HEADER_FIELDS)


def nested_orders(orders: DataFrame, lineitem: DataFrame, max_items: int = 1000) -> DataFrame:
    """One document per order and block of at most ``max_items`` items.

    Items are dealt into blocks by their position in the order (line number, then the other
    fields), so repeated line numbers can't swell a block. Block 0 is the document itself and
    later blocks continue it: what counts documents reads ``order_headers`` or block 0.
    """
    from corvid.operators.windows import running
    placed = running(lineitem.select("l_orderkey", *ITEM_FIELDS).withColumn("_one", F.lit(1)), ["l_orderkey"],
                     ITEM_FIELDS, {"_pos": ("count", "_one")})
    items = (placed.withColumn("_block", F.floor((F.col("_pos") - 1) / max_items))
             .groupBy("l_orderkey", "_block")
             .agg(F.sort_array(F.collect_list(F.struct(*ITEM_FIELDS))).alias("items")))
    from corvid.operators.joins import equi_join
    # an order's blocks may be many (a hot order): the skew-tolerant outer join splits them
    return (equi_join(orders, items, "o_orderkey", "l_orderkey", "left")
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    "o_orderpriority", F.coalesce("_block", F.lit(0)).alias("block"),
                    F.coalesce("items", F.array().cast(
                        "array<struct<l_linenumber:int,l_partkey:bigint,l_suppkey:bigint,"
                        "l_quantity:double,l_extendedprice:double,l_discount:double,"
                        "l_returnflag:string,l_shipdate:timestamp_ntz>>")).alias("items")))
