"""The generic operators on the order, line item and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casemart.functions import days_between, mean_of
from casemart.operators import (
    dedup_by_priority,
    delay_by_group,
    duplicate_audit,
    flag_counts,
    group_counts,
    profile,
    rate_by_group,
    share_of_total,
    value_counts,
)


def rate_lineitem_returnflag(lineitem: DataFrame) -> DataFrame:
    marked = lineitem.select(
        "l_returnflag",
        (F.col("l_linestatus") == "O").alias("open"),
        (F.col("l_discount") >= 0.05).alias("discounted"),
    )
    flags = {"n_open": "open", "n_discounted": "discounted"}
    return rate_by_group(marked, ["l_returnflag"], flags, digits=4)


def delay_orders_ship(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Mean days from order to shipment, per order priority.

    Line items are folded to one row per order before the join: the mean of (ship - order) needs
    only the sum of ship days and their number. The fold happens before rows travel, so an order
    with most of the line items is not one large join partition.
    """
    day = F.datediff(F.col("l_shipdate"), F.lit("1970-01-01").cast("date"))
    shipped = lineitem.groupBy("l_orderkey").agg(
        F.sum(day).alias("ship_days"), F.count(day).alias("n")
    )
    order_day = F.datediff(F.col("o_orderdate"), F.lit("1970-01-01").cast("date"))
    return (
        orders.select("o_orderkey", "o_orderpriority", order_day.alias("order_day"))
        .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_orderpriority")
        .agg(
            F.sum("n").alias("n_items"),
            F.sum(F.col("ship_days") - F.col("n") * F.col("order_day")).alias("total_days"),
        )
        .withColumn("mean_days", mean_of("total_days", "n_items", 2))
    )


def delay_items_by_flag(lineitem: DataFrame) -> DataFrame:
    """Mean days between the start of the year and the shipment, per return flag and line status."""
    start = F.trunc("l_shipdate", "year")
    days = lineitem.select(
        "l_returnflag", "l_linestatus", days_between("l_shipdate", start).alias("day_of_year")
    )
    return delay_by_group(days, ["l_returnflag", "l_linestatus"], {"mean_day": "day_of_year"})


def events_per_day(events: DataFrame) -> DataFrame:
    marked = events.select(
        F.col("ts").cast("date").alias("day"),
        (F.col("event_type") == "purchase").alias("purchase"),
        (F.col("event_type") == "error").alias("error"),
    )
    flags = {"n_purchase": "purchase", "n_error": "error"}
    return flag_counts(marked, ["day"], flags, null_as_zero=True, total="n_events").orderBy("day")


def dedup_lineitem_latest(lineitem: DataFrame) -> DataFrame:
    """The latest shipment per (order, line number); every other column breaks ties."""
    return dedup_by_priority(
        lineitem, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()]
    )


def duplicate_lineitems(lineitem: DataFrame) -> DataFrame:
    return duplicate_audit(lineitem, ["l_orderkey", "l_linenumber"])


def profile_lineitem(lineitem: DataFrame) -> DataFrame:
    return profile(lineitem)


def share_orders_priority(orders: DataFrame) -> DataFrame:
    return share_of_total(orders, ["o_orderpriority"], digits=4)


def value_counts_lineitem(lineitem: DataFrame) -> DataFrame:
    return value_counts(lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


def orders_per_customer(orders: DataFrame) -> DataFrame:
    return group_counts(orders, ["o_custkey"], "n_orders")
