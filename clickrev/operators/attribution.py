"""Purchases, their attribution to search sessions, and the report."""
from pyspark.sql import DataFrame, functions as F

from clickrev.fixed_values import PURCHASE_EVENT, REPORT_HEADINGS
from clickrev.functions.events import has_event
from clickrev.operators.names import own_names


def purchase_hits(hits: DataFrame) -> DataFrame:
    """Rows whose event list holds the purchase event."""
    return hits.filter(has_event(F.col("event_list"), PURCHASE_EVENT))


def purchase_revenue(products: DataFrame) -> DataFrame:
    """``ip, product_name, product_total_revenue`` of products bought for more than nothing."""
    return (
        purchase_hits(products)
        .filter(F.col("product_total_revenue") > 0)
        .select("ip", "product_name", "product_total_revenue")
    )


def attributed_purchases(sessions: DataFrame, purchases: DataFrame) -> DataFrame:
    """Every search session with each of its purchases, or once with revenue 0.0.

    The left join on ``ip``; sessions without an ``ip`` match nothing. It is an inner join,
    of which adaptive execution can split a busy visitor on either side (of a left join it
    cannot split the purchases), and the sessions without a partner, which meet one row per
    visitor that bought.
    """
    _ = own_names(sessions, purchases)
    more = [name for name in purchases.columns if name != "ip"]
    buyers = purchases.groupBy(F.col("ip").alias(_("ip"))).agg(F.count(F.lit(1)))
    idle = sessions.join(buyers, F.col("ip") == F.col(_("ip")), "left_anti")
    return (
        sessions.join(purchases, "ip")
        .select(*sessions.columns, *more)
        .unionByName(idle, allowMissingColumns=True)
        .withColumn("product_total_revenue", F.coalesce("product_total_revenue", F.lit(0.0)))
    )


def revenue_by_keyword(sessions: DataFrame, purchases: DataFrame) -> DataFrame:
    """``search_engine_domain, search_keyword, revenue``, one row per engine and keyword.

    The sum over :func:`attributed_purchases`. Purchases are summed per visitor
    first, so the join meets at most one row per visitor on either side. Both
    sides are then already partitioned by ``ip`` and join without another shuffle.
    """
    spent = (
        purchases.filter(F.col("ip").isNotNull())
        .groupBy("ip")
        .agg(F.sum("product_total_revenue").alias("spent"))
    )
    return (
        sessions.join(spent, "ip", "left")
        .groupBy("search_engine_domain", "search_keyword")
        .agg(F.sum(F.coalesce("spent", F.lit(0.0))).alias("revenue"))
    )


def search_keyword_performance(sessions: DataFrame, purchases: DataFrame) -> DataFrame:
    """The report: revenue by engine and keyword under its printed headings, best first."""
    return (
        revenue_by_keyword(sessions, purchases)
        .orderBy(F.col("revenue").desc(), "search_engine_domain", "search_keyword")
        .withColumnsRenamed(REPORT_HEADINGS)
    )
