"""Joins of points in time with intervals, as an equi-join on blocks of time.

An interval belongs to the finest of eight levels at which it meets at most 17 blocks: blocks of
level L are 2^L seconds, and levels are four bits apart. So a long interval is split into few
pieces, however long it is, and a short one does not share a block with all points of a year. A
point lies in one block per level. Points are first reduced to one row per key and second; the
rows themselves meet the outcome on key and second. Both joins are inner ones, which adaptive
execution splits where a key, a block or a second is hot.
"""
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clickrev.functions.orders import order_total
from clickrev.operators.names import own_names

_INT_MIN, _INT_MAX = -(1 << 31), (1 << 31) - 1
_LEVELS = range(0, 32, 4)
_LENGTH_IN_BLOCKS = 16


def interval_join(
    points: DataFrame, intervals: DataFrame, time: str, start: str, end: str, by: Sequence[str] = ()
) -> DataFrame:
    """Every row of ``points`` with every interval that holds its time, both ends included.

    Columns of ``points``, then those of ``intervals`` that ``points`` lacks. Both share the
    columns ``by``, whose values must be equal; a NULL equals nothing. ``time`` is an INT, ``start``
    and ``end`` are whole numbers. An interval without one of its ends, or one that ends before
    it starts, holds nothing. Equal rows, on either side, all count.
    """
    _ = own_names(points, intervals)
    keys = {name: _(f"key{number}") for number, name in enumerate(by)}
    level, block, second = _("level"), _("block"), _("second")

    seconds = (
        points.filter(F.col(time).isNotNull())
        .select(F.col(time).cast("long").alias(second), *[F.col(name).alias(key) for name, key in keys.items()])
        .dropna()
        .distinct()
        .withColumn(level, F.explode(F.array(*[F.lit(bits) for bits in _LEVELS])))
        .withColumn(block, F.expr(f"shiftright({second}, {level})"))
    )

    first, last = F.col(_("first")), F.col(_("last"))
    finest = F.coalesce(
        *[F.when(last - first <= _LENGTH_IN_BLOCKS << bits, F.lit(bits)) for bits in _LEVELS]
    )
    new = [name for name in intervals.columns if name not in points.columns]
    pieces = (
        intervals.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
        .select(
            F.greatest(F.col(start).cast("long"), F.lit(_INT_MIN).cast("long")).alias(_("first")),
            F.least(F.col(end).cast("long"), F.lit(_INT_MAX).cast("long")).alias(_("last")),
            *[F.col(name).alias(_(f"key_of{number}")) for number, name in enumerate(by)],
            F.struct(*[F.col(name) for name in new]).alias(_("row")) if new else F.lit(None).alias(_("row")),
        )
        .filter(first <= last)
        .withColumn(_("level_of"), finest)
        .withColumn(
            _("block_of"),
            F.expr("explode(sequence(shiftright({0}, {2}), shiftright({1}, {2})))".format(*map(_, ("first", "last", "level_of")))),
        )
    )
    meet = (F.col(level) == F.col(_("level_of"))) & (F.col(block) == F.col(_("block_of")))
    for number, key in enumerate(keys.values()):
        meet &= F.col(key) == F.col(_(f"key_of{number}"))
    held = (
        seconds.join(pieces, meet & F.col(second).between(first, last))
        .select(second, *keys.values(), _("row"))
    )
    same = points[time].cast("long") == held[second]
    for name, key in keys.items():
        same &= points[name] == held[key]
    return points.join(held, same).select(
        *[points[name] for name in points.columns], *[held[_("row")][name].alias(name) for name in new]
    )


def offer_hits(hits: DataFrame, offers: DataFrame) -> DataFrame:
    """Every hit of a visitor while one of the visitor's offers ran, with that offer.

    ``offers`` are ``offer, ip, starts, ends``.
    """
    return interval_join(hits, offers, "hit_time_gmt", "starts", "ends", by=["ip"])


def offer_report(hits: DataFrame, offers: DataFrame) -> DataFrame:
    """``offer, ip, starts, ends, n_hits, revenue`` of the offers during which there was a hit.

    Hits are summed per visitor and second before they meet an offer, so the join sees no more
    rows than there are seconds.
    """
    seconds = hits.groupBy("ip", "hit_time_gmt").agg(
        F.count(F.lit(1)).alias("n"), F.sum(order_total(F.col("event_list"), F.col("product_list"))).alias("spent")
    )
    return (
        interval_join(seconds, offers.select("offer", "ip", "starts", "ends"), "hit_time_gmt", "starts", "ends", by=["ip"])
        .groupBy("offer", "ip", "starts", "ends")
        .agg(F.sum("n").alias("n_hits"), F.sum("spent").alias("revenue"))
    )
