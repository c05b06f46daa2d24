"""Work along each visitor's time line that no window over a visitor has to hold.

A time line is first reduced to one row per visitor and second, by hash aggregates with a
partial step, so a busy visitor costs a reducer at most one row per second and task. Seconds
are then dealt into spans of 2^16 seconds. A window only ever holds one span of one visitor
(65,536 rows) or one row per span of one visitor (65,536 for INT times); what a span needs to
know of earlier ones is carried over the spans and joined back. The last join meets the full
rows on visitor and second, where adaptive execution splits a skewed second.
"""
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickrev.fixed_values import SEARCH_ENGINES
from clickrev.functions.referrer import Engines
from clickrev.operators.attribution import purchase_hits
from clickrev.operators.names import own_names
from clickrev.operators.products import product_level
from clickrev.operators.sessions import with_search_origin

SPAN_BITS = 16
#: Seconds without a hit after which a visitor's next hit opens a new session.
GAP = 1800


def _span(time: str) -> Column:
    return F.shiftright(F.col(time), SPAN_BITS)


def as_of(
    left: DataFrame, right: DataFrame, key: str, time: str, values: Sequence[str], since: str | None = None
) -> DataFrame:
    """Every row of ``left`` with the ``values`` that ``right`` holds for its key as of its time.

    That is the row of ``right`` with the same ``key`` and the latest ``time`` not after that of
    ``left``; of several at that time the smallest in the order of ``values``. Rows without
    such a row, a key or a time keep NULLs. ``since``, if given, names a column for the time of
    the row found. ``time`` is a whole number in both frames.
    """
    _ = own_names(left, right)
    known = F.struct(F.col(time).cast("long").alias("at"), *values)
    seconds = (
        right.select(F.col(key).alias(_("key")), F.col(time).cast("long").alias(_("time")), known.alias(_("known")))
        .withColumn(_("asked"), F.lit(False))
        .unionByName(
            left.select(F.col(key).alias(_("key")), F.col(time).cast("long").alias(_("time"))).withColumn(
                _("asked"), F.lit(True)
            ),
            allowMissingColumns=True,
        )
        .filter(F.col(_("key")).isNotNull() & F.col(_("time")).isNotNull())
        .groupBy(_("key"), _("time"))
        .agg(F.min(_("known")).alias(_("known")), F.max(_("asked")).alias(_("asked")))
        .withColumn(_("span"), _span(_("time")))
    )
    until_now = (
        Window.partitionBy(_("key"), _("span")).orderBy(_("time")).rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier_spans = (
        Window.partitionBy(_("span_key")).orderBy(_("span_of")).rowsBetween(Window.unboundedPreceding, -1)
    )
    # the time leads in the struct, so the greatest is the latest
    spans = (
        seconds.groupBy(F.col(_("key")).alias(_("span_key")), F.col(_("span")).alias(_("span_of")))
        .agg(F.max(_("known")).alias(_("last")))
        .withColumn(_("carried"), F.max(_("last")).over(earlier_spans))
    )
    answers = (
        seconds.withColumn(_("here"), F.max(_("known")).over(until_now))
        .filter(_("asked"))
        .join(spans, (F.col(_("key")) == F.col(_("span_key"))) & (F.col(_("span")) == F.col(_("span_of"))))
        .select(_("key"), _("time"), F.coalesce(_("here"), _("carried")).alias(_("found")))
    )
    same = (left[key] == answers[_("key")]) & (left[time].cast("long") == answers[_("time")])
    found = [F.col(_("found"))[name].alias(name) for name in values]
    if since:
        found.append(F.col(_("found"))["at"].alias(since))
    return left.join(answers, same, "left").select(*[left[name] for name in left.columns], *found)


def search_hits(hits: DataFrame, engines: Engines = SEARCH_ENGINES) -> DataFrame:
    """``ip, hit_time_gmt, search_engine_domain, search_keyword`` of hits that came from a search."""
    return (
        hits.select("ip", "hit_time_gmt", "referrer")
        .transform(with_search_origin, "referrer", engines)
        .filter("search_keyword <> ''")
        .drop("referrer")
    )


def asof_attribution(hits: DataFrame, engines: Engines = SEARCH_ENGINES) -> DataFrame:
    """Every product bought, with the last search that brought its visitor in until then.

    ``ip, hit_time_gmt, product_name, product_total_revenue, search_engine_domain,
    search_keyword, search_time``. Unlike a session's origin, which is that of the visitor's
    first hit, this is the latest search hit at or before the purchase. Purchases without one
    keep NULLs.
    """
    bought = (
        purchase_hits(product_level(hits))
        .filter(F.col("product_total_revenue") > 0)
        .select("ip", "hit_time_gmt", "product_name", "product_total_revenue")
    )
    origin = ["search_engine_domain", "search_keyword"]
    return as_of(bought, search_hits(hits, engines), "ip", "hit_time_gmt", origin, since="search_time")


def asof_revenue_by_keyword(hits: DataFrame, engines: Engines = SEARCH_ENGINES) -> DataFrame:
    """``search_engine_domain, search_keyword, revenue, n_products`` by the last search.

    What is bought without an earlier search stands under NULL.
    """
    return (
        asof_attribution(hits, engines)
        .groupBy("search_engine_domain", "search_keyword")
        .agg(F.sum("product_total_revenue").alias("revenue"), F.count(F.lit(1)).alias("n_products"))
    )


def session_numbers(hits: DataFrame, gap: int = GAP) -> DataFrame:
    """``ip, hit_time_gmt, session_number, n_hits``: one row per visitor and second with a hit.

    A visitor's first hit opens session 1; a hit more than ``gap`` after the one before opens
    the next. Hits without a time belong to no session; those without an ``ip`` are one
    visitor's.
    """
    time = F.col("hit_time_gmt").cast("long")
    seconds = (
        hits.filter(F.col("hit_time_gmt").isNotNull())
        .groupBy("ip", time.alias("time"))
        .agg(F.count(F.lit(1)).alias("n_hits"))
        .withColumn("span", _span("time"))
    )
    in_span = Window.partitionBy("ip", "span").orderBy("time")
    until_now = in_span.rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.col("time") - F.lag("time").over(in_span) > gap, F.lit(False))
    seconds = seconds.withColumn("opens", opens.cast("long"))
    over_spans = Window.partitionBy("span_ip").orderBy("span_of")
    earlier = over_spans.rowsBetween(Window.unboundedPreceding, -1)
    span_opens = F.coalesce(F.col("first") - F.lag("last").over(over_spans) > gap, F.lit(True))
    spans = (
        seconds.groupBy(F.col("ip").alias("span_ip"), F.col("span").alias("span_of"))
        .agg(F.min("time").alias("first"), F.max("time").alias("last"), F.sum("opens").alias("inside"))
        .withColumn("span_opens", span_opens.cast("long"))
        .withColumn(
            "before", F.coalesce(F.sum(F.col("inside") + F.col("span_opens")).over(earlier), F.lit(0)) + F.col("span_opens")
        )
        .select("span_ip", "span_of", "before")
    )
    number = F.col("before") + F.col("so_far")
    return (
        seconds.withColumn("so_far", F.sum("opens").over(until_now))
        .join(spans, F.col("ip").eqNullSafe(F.col("span_ip")) & (F.col("span") == F.col("span_of")))
        .select("ip", F.col("time").alias("hit_time_gmt"), number.alias("session_number"), "n_hits")
    )


def gap_sessions(hits: DataFrame, gap: int = GAP) -> DataFrame:
    """``hits`` with ``session_number``, counted per visitor from 1; NULL without a time."""
    _ = own_names(hits)
    numbers = session_numbers(hits, gap).select(
        F.col("ip").alias(_("ip")), F.col("hit_time_gmt").alias(_("time")), "session_number"
    )
    same = hits["ip"].eqNullSafe(F.col(_("ip"))) & (hits["hit_time_gmt"].cast("long") == F.col(_("time")))
    columns = [hits[name] for name in hits.columns if name != "session_number"]
    return hits.join(numbers, same, "left").select(*columns, numbers["session_number"])


def gap_session_report(hits: DataFrame, gap: int = GAP, engines: Engines = SEARCH_ENGINES) -> DataFrame:
    """One row per visitor and session: extent, hits, the search it began with, revenue.

    ``ip, session_number, session_start, session_end, n_hits, search_engine_domain,
    search_keyword, revenue``. The search is that of the session's first second, the smallest
    of several, NULL if there is none. What is known per second (a count, the smallest search,
    the revenue) comes from aggregates, so no row of the hits is joined or sorted.
    """
    _ip, _time = F.col("ip").alias("of_ip"), F.col("hit_time_gmt").cast("long").alias("of_time")
    search = F.min(F.struct("search_engine_domain", "search_keyword"))
    searches = search_hits(hits, engines).groupBy(_ip, _time).agg(search.alias("search"))
    spent = (
        purchase_hits(product_level(hits))
        .filter(F.col("product_total_revenue") > 0)
        .groupBy(_ip, _time)
        .agg(F.sum("product_total_revenue").alias("spent"))
    )
    known = (
        searches.unionByName(spent, allowMissingColumns=True)
        .groupBy("of_ip", "of_time")
        .agg(F.max("search").alias("search"), F.max("spent").alias("spent"))
    )
    same = F.col("ip").eqNullSafe(F.col("of_ip")) & (F.col("hit_time_gmt") == F.col("of_time"))
    first = F.min(F.struct("hit_time_gmt", "search"))["search"]
    return (
        session_numbers(hits, gap)
        .join(known, same, "left")
        .groupBy("ip", "session_number")
        .agg(
            F.min("hit_time_gmt").alias("session_start"),
            F.max("hit_time_gmt").alias("session_end"),
            F.sum("n_hits").alias("n_hits"),
            first.alias("search"),
            F.coalesce(F.sum("spent"), F.lit(0.0)).alias("revenue"),
        )
        .select(
            "ip", "session_number", "session_start", "session_end", "n_hits",
            "search.search_engine_domain", "search.search_keyword", "revenue",
        )
    )
