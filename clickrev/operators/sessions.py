"""Where each visitor came from. A visitor, and so a session, is one ``ip``."""
from pyspark.sql import DataFrame, functions as F

from clickrev.fixed_values import SEARCH_ENGINES
from clickrev.functions.referrer import Engines, search_engine, search_keyword
from clickrev.functions.url import host_of, without_line_breaks
from clickrev.operators.names import own_names


def with_search_origin(
    df: DataFrame, url: str = "referrer", engines: Engines = SEARCH_ENGINES
) -> DataFrame:
    """Add ``search_engine_domain`` and ``search_keyword``, read from the column ``url``.

    The cleaned URL and its host are columns of their own so that each pattern
    runs once per row, not once per known domain. The keyword is only looked for
    where an engine was found.
    """
    _ = own_names(df)
    return (
        df.withColumn(_("url"), without_line_breaks(F.col(url)))
        .withColumn(_("host"), host_of(F.col(_("url"))))
        .withColumn("search_engine_domain", search_engine(F.col(_("host")), engines))
        .withColumn(
            "search_keyword",
            search_keyword(F.col(_("url")), F.col("search_engine_domain"), engines),
        )
        .drop(_("url"), _("host"))
    )


def session_search_origin(hits: DataFrame, engines: Engines = SEARCH_ENGINES) -> DataFrame:
    """``ip, search_engine_domain, search_keyword`` of visitors whose entry hit came from a search.

    The entry hit is the earliest one; a hit without a time counts as earliest.
    Of several hits at that time a search-driven one goes first, then the
    smallest engine and keyword, so the result does not depend on partitioning.

    One aggregate instead of rank, filter and dedupe: each task reduces its hits
    to one row per visitor before the only shuffle, so a very busy ``ip`` costs
    its reducer one row per task.
    """
    from_search = F.coalesce(F.col("search_keyword") != "", F.lit(False))
    entry = F.min(
        F.struct(
            "hit_time_gmt",
            (~from_search).alias("other"),
            F.when(from_search, F.col("search_engine_domain")).alias("search_engine_domain"),
            F.when(from_search, F.col("search_keyword")).alias("search_keyword"),
        )
    )
    return (
        hits.select("ip", "hit_time_gmt", "referrer")
        .transform(with_search_origin, "referrer", engines)
        .groupBy("ip")
        .agg(entry.alias("entry"))
        .filter(~F.col("entry.other"))
        .select("ip", "entry.search_engine_domain", "entry.search_keyword")
    )
