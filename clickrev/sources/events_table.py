"""The generic ``events`` table in the shape of raw hits.

Every event becomes one hit, so work on the hits grows with the table. The texts
are chosen to meet the rules of the operators: padded and blank strings, NULLs,
several products per hit, unreadable and missing attributes, tied hit times,
referrers of three engines, of the shop itself and of a look-alike domain.
"""
from pyspark.sql import Column, DataFrame, functions as F


def _concat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def hits_from_events(events: DataFrame) -> DataFrame:
    """``events`` as raw hits. Times are whole hours, so that visitors have ties."""
    event_id, user_id, event_type = F.col("event_id"), F.col("user_id"), F.col("event_type")
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")

    hour = F.date_diff(F.to_date("ts"), F.lit("1970-01-01").cast("date")) * 24 + F.hour("ts")
    events_by_type = (
        F.when((event_type == "purchase") & (event_id % 2 == 0), "1")
        .when(event_type == "purchase", "2, 1 ,12")
        .when(event_type == "view", "2")
        .when(event_type == "click", "10,12")
        .when(event_type == "signup", "11")
        .when(event_type == "error", "")
    )
    bought = _concat(
        "Cat", (user_id % 5).cast("string"), ";item;1;",
        F.col("value").cast("decimal(18,2)").cast("string"),
        ";200|201, Extra;e2;2;1.25",
    )
    products = F.when(event_type == "purchase", bought).when(event_type == "view", "Cat;item;1;;")
    word = (k % 5).cast("string")
    referrer = (
        F.when(event_id % 7 == 0, _concat("http://www.google.com/search?hl=en&q=Word+", word))
        .when(event_id % 7 == 1, _concat("http://search.yahoo.com/search?p=word%20", word, "&q=zzz"))
        .when(
            event_id % 7 == 2,
            _concat("http://www.bing.com/search?q=", F.when(k % 3 == 0, "").otherwise("Zune")),
        )
        .when(event_id % 7 == 3, "http://shop.example.com/cart/?q=inside")
        .when(event_id % 7 == 4, "http://notgoogle.com/?q=x")
        .when(event_id % 7 == 5, "   ")
    )
    return events.select(
        hour.cast("int").alias("hit_time_gmt"),
        F.col("ts").cast("timestamp").alias("date_time"),
        _concat("  Agent/", (k % 3).cast("string"), " ").alias("user_agent"),
        _concat("10.0.0.", user_id.cast("string")).alias("ip"),
        events_by_type.alias("event_list"),
        _concat(" City ", (user_id % 10).cast("string")).alias("geo_city"),
        _concat("R", (user_id % 4).cast("string")).alias("geo_region"),
        F.lit("US").alias("geo_country"),
        _concat(event_type, "  ").alias("pagename"),
        _concat(
            "http://shop.example.com/", event_type, "?id=", event_id.cast("string")
        ).alias("page_url"),
        products.alias("product_list"),
        referrer.alias("referrer"),
    )
