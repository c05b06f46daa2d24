"""

Every query runs over a whole driver table: ``events`` in the shape of raw hits
(see ``clickrev.sources.events_table``) or ``pages``. The SQL twins build the
same hits from ``events`` in a shared chain of common table expressions, written
apart from the Spark code.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.fixed_values import (
    ALL_HITS,
    ALL_HITS_CSV,
    PRODUCT_LEVEL,
    RAW_SEPARATOR,
    RAW_TIMESTAMP_FORMAT,
)
from clickrev.functions import query_param, url_host
from clickrev.operators import (
    asof_attribution,
    asof_revenue_by_keyword,
    attributed_purchases,
    blank_to_null,
    clean_hits,
    first_hits,
    gap_session_report,
    gap_sessions,
    offer_hits,
    offer_report,
    product_entries,
    product_hits,
    product_level,
    purchase_hits,
    purchase_revenue,
    rank_hits,
    revenue_by_keyword,
    search_keyword_performance,
    session_search_origin,
    trim_strings,
    with_search_origin,
)
from clickrev.plans import conform, curate, keyword_report
from clickrev.sources import (
    publish_report,
    read_all_hits,
    read_hits_tsv,
    read_product_level,
    report_file_name,
    write_csv,
    write_parquet,
)
from clickrev.sources.events_table import hits_from_events
from clickrev.sources.files import join_path
from clickrev.sources.workspace import workspace
from clickrev.streaming import conform_stream, stream_sessions

try:
    import corpus_pipeline  # noqa: F401
    from clickrev.llm import registry as _llm
except ImportError as error:  # the subpackage and the pipeline may be taken out
    logging.getLogger(__name__).warning("without the operators for training data: %s", error)
    _llm = None

_FLAGSHIP_DIR = "/root/testdata/sf0.001"
_RUN_DATE = date(2024, 2, 1)
# The times of the events are whole hours.
_GAP_HOURS = 12


# --- Inputs ------------------------------------------------------------------


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _all_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_hits(_hits(spark, sf_dir))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_level(_all_hits(spark, sf_dir))


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_search_origin(_all_hits(spark, sf_dir))


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchase_revenue(_products(spark, sf_dir))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def _write_raw(hits: DataFrame, path: str) -> None:
    """Hits as a raw tab-delimited file, blanks around values kept."""
    hits.write.csv(
        path,
        sep=RAW_SEPARATOR,
        header=True,
        timestampFormat=RAW_TIMESTAMP_FORMAT,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def _in_cents(report: DataFrame) -> DataFrame:
    """Sums of doubles depend on the order of the rows; cents do not."""
    return report.withColumn("Revenue", F.round("Revenue", 2))


# --- Queries -----------------------------------------------------------------


def _search_keyword_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_cents(keyword_report(_all_hits(spark, sf_dir)))


def _read_hits_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "raw")
    _write_raw(_hits(spark, sf_dir), path)
    return read_hits_tsv(spark, path)


def _conformed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "hits")
    write_parquet(_all_hits(spark, sf_dir), path)
    return read_all_hits(spark, path)


def _product_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "products")
    write_parquet(_products(spark, sf_dir), path)
    return read_product_level(spark, path)


def _csv_copy_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "csv")
    products = _products(spark, sf_dir)
    write_csv(products, path)
    return spark.read.csv(path, header=True, schema=products.schema)


def _read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(
        path,
        sep="\t",
        header=True,
        schema="`Search Engine Domain` STRING, `Search Keyword` STRING, `Revenue` DOUBLE",
    )


def _report_tab_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = search_keyword_performance(_sessions(spark, sf_dir), _purchases(spark, sf_dir))
    path = publish_report(report, workspace(spark, "report"), report_file_name(_RUN_DATE))
    return _read_report(spark, path)


def _conform_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 1 on a raw file; a summary of the tables it wrote."""
    folder = workspace(spark, "conform")
    raw, out_dir = join_path(folder, "raw"), join_path(folder, "conformed")
    _write_raw(_hits(spark, sf_dir), raw)
    conform(spark, raw, out_dir)

    def summary(table: str, df: DataFrame, measure: str) -> DataFrame:
        return df.agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct("ip").alias("n_visitors"),
            F.count(measure).alias("n_measured"),
        )

    hits = read_all_hits(spark, join_path(out_dir, ALL_HITS))
    copy = spark.read.csv(join_path(out_dir, ALL_HITS_CSV), header=True, schema=hits.schema)
    products = read_product_level(spark, join_path(out_dir, PRODUCT_LEVEL))
    return (
        summary(ALL_HITS, hits, "referrer")
        .unionByName(summary(ALL_HITS_CSV, copy, "referrer"))
        .unionByName(summary(PRODUCT_LEVEL, products, "product_total_revenue"))
    )


def _curate_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs, from a raw file to the report file."""
    folder = workspace(spark, "curate")
    raw, conformed = join_path(folder, "raw"), join_path(folder, "conformed")
    _write_raw(_hits(spark, sf_dir), raw)
    conform(spark, raw, conformed, csv_copies=False)
    return _read_report(spark, curate(spark, conformed, join_path(folder, "curated"), _RUN_DATE))


def _stage_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage stored and counted by the library's own sink, from the stage before."""
    folder = workspace(spark, "counts")
    rows: list[tuple[str, int]] = []

    def store(stage: str, df: DataFrame) -> DataFrame:
        path = join_path(folder, stage)
        rows.append((stage, write_parquet(df, path)))
        return spark.read.schema(df.schema).parquet(path)

    raw = store("raw_hits", _hits(spark, sf_dir))
    hits = store("all_hits", clean_hits(raw))
    products = store("product_level", product_level(hits))
    sessions = store("sessions", session_search_origin(hits))
    purchases = store("purchases", purchase_revenue(products))
    store("report", revenue_by_keyword(sessions, purchases))
    return spark.createDataFrame(rows, "stage STRING, n_rows BIGINT")


def _url_host_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _pages(spark, sf_dir)
        .groupBy(url_host(F.col("url")).alias("host"))
        .agg(F.count(F.lit(1)).alias("n_pages"))
    )


def _url_param_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("page", "ref", "utm_source")
    return (
        _pages(spark, sf_dir)
        .groupBy(*[query_param(F.col("url"), name).alias(name) for name in names])
        .agg(F.count(F.lit(1)).alias("n_pages"))
    )


def _revenue_by_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = revenue_by_keyword(_sessions(spark, sf_dir), _purchases(spark, sf_dir))
    return revenue.withColumn("revenue", F.round("revenue", 2))


def _asof_revenue_by_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = asof_revenue_by_keyword(_all_hits(spark, sf_dir))
    return revenue.withColumn("revenue", F.round("revenue", 2))


def _gap_session_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = gap_session_report(_all_hits(spark, sf_dir), _GAP_HOURS)
    return report.withColumn("revenue", F.round("revenue", 2))


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An offer per visitor who signs up, running for 0 to 1,000 hours."""
    number = F.regexp_extract("page_url", "id=([0-9]+)", 1).cast("long")
    return (
        _all_hits(spark, sf_dir)
        .filter("event_list = '11'")
        .select(
            F.col("page_url").alias("offer"),
            "ip",
            F.col("hit_time_gmt").cast("long").alias("starts"),
            (F.col("hit_time_gmt") + F.pow(number % 11, F.lit(3)).cast("long")).alias("ends"),
        )
    )


def _offer_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offer_hits(_all_hits(spark, sf_dir), _offers(spark, sf_dir)).select(
        "ip", "hit_time_gmt", "page_url", "offer", "starts", "ends"
    )


def _offer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = offer_report(_all_hits(spark, sf_dir), _offers(spark, sf_dir))
    return report.withColumn("revenue", F.round("revenue", 2))


def _stream_in_two_runs(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The hits as raw files of two halves of their time; the stream runs after each half."""
    folder = workspace(spark, "stream")
    raw, out_dir, state = [join_path(folder, name) for name in ("raw", "conformed", "state")]
    hits = _hits(spark, sf_dir)
    middle = hits.agg(F.avg("hit_time_gmt")).first()[0] or 0.0
    for lot, half in enumerate([F.col("hit_time_gmt") < middle, F.col("hit_time_gmt") >= middle]):
        _write_raw(hits.filter(half), join_path(raw, f"lot-{lot}"))
        conform_stream(spark, join_path(raw, "lot-*"), out_dir, state, gap=_GAP_HOURS, delay=2 * _GAP_HOURS)
    return out_dir, state


def _stream_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir, _ = _stream_in_two_runs(spark, sf_dir)
    return read_product_level(spark, join_path(out_dir, PRODUCT_LEVEL))


def _stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = stream_sessions(spark, *_stream_in_two_runs(spark, sf_dir))
    return sessions.withColumn("revenue", F.round("revenue", 2))


def entry(spark: SparkSession) -> DataFrame:
    """The keyword report over the smallest scale factor."""
    return _search_keyword_performance(spark, _FLAGSHIP_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator; each takes (spark, sf_dir)."""
    origin_columns = ["ip", "hit_time_gmt", "referrer"]
    on_tables = {
        # sources and sinks
        "read_hits_tsv": _read_hits_tsv,
        "conformed_roundtrip": _conformed_roundtrip,
        "product_roundtrip": _product_roundtrip,
        "csv_copy_roundtrip": _csv_copy_roundtrip,
        "report_tab_roundtrip": _report_tab_roundtrip,
        # projection and cleaning
        "trim_strings": lambda spark, sf: trim_strings(_hits(spark, sf)),
        "blank_to_null": lambda spark, sf: blank_to_null(trim_strings(_hits(spark, sf))).select(
            "ip", "hit_time_gmt", "event_list", "product_list", "referrer"
        ),
        "clean_hits": _all_hits,
        # products
        "product_hits": lambda spark, sf: product_hits(_all_hits(spark, sf)),
        "product_entries": lambda spark, sf: product_entries(_all_hits(spark, sf)).select(
            "ip", "hit_time_gmt", "event_list", "product_entry"
        ),
        "product_level": _products,
        # referrers
        "search_engine": lambda spark, sf: with_search_origin(_all_hits(spark, sf)).select(
            *origin_columns, "search_engine_domain"
        ),
        "search_keyword": lambda spark, sf: with_search_origin(_all_hits(spark, sf)).select(
            *origin_columns, "search_engine_domain", "search_keyword"
        ),
        "url_host_counts": _url_host_counts,
        "url_param_counts": _url_param_counts,
        # sessions
        "hit_rank": lambda spark, sf: rank_hits(_all_hits(spark, sf)).select(
            *origin_columns, "page_url", "hit_rank"
        ),
        "first_hits": lambda spark, sf: first_hits(_all_hits(spark, sf)),
        "session_search_origin": _sessions,
        # purchases and revenue
        "purchase_hits": lambda spark, sf: purchase_hits(_all_hits(spark, sf)),
        "purchase_revenue": _purchases,
        "attributed_purchases": lambda spark, sf: attributed_purchases(
            _sessions(spark, sf), _purchases(spark, sf)
        ),
        "revenue_by_keyword": _revenue_by_keyword,
        "search_keyword_performance": _search_keyword_performance,
        # time lines
        "asof_attribution": lambda spark, sf: asof_attribution(_all_hits(spark, sf)),
        "asof_revenue_by_keyword": _asof_revenue_by_keyword,
        "gap_sessions": lambda spark, sf: gap_sessions(_all_hits(spark, sf), _GAP_HOURS).select(
            "ip", "hit_time_gmt", "page_url", "session_number"
        ),
        "gap_session_report": _gap_session_report,
        "offer_hits": _offer_hits,
        "offer_report": _offer_report,
        # streams
        "stream_product_level": _stream_products,
        "stream_sessions": _stream_sessions,
        # jobs
        "stage_row_counts": _stage_row_counts,
        "conform_job": _conform_job,
        "curate_job": _curate_job,
    }
    return on_tables | (_llm.queries() if _llm else {})


# --- SQL twins ---------------------------------------------------------------

_TABLES_SQL = r"""
WITH numbered AS (
    SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events
),
hits AS (
    SELECT
        CAST(floor(epoch(ts) / 3600) AS INTEGER) AS hit_time_gmt,
        ts AS date_time,
        '  Agent/' || (k % 3) || ' ' AS user_agent,
        '10.0.0.' || user_id AS ip,
        CASE event_type
            WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN '1' ELSE '2, 1 ,12' END
            WHEN 'view' THEN '2'
            WHEN 'click' THEN '10,12'
            WHEN 'signup' THEN '11'
            WHEN 'error' THEN ''
        END AS event_list,
        ' City ' || (user_id % 10) AS geo_city,
        'R' || (user_id % 4) AS geo_region,
        'US' AS geo_country,
        event_type || '  ' AS pagename,
        'http://shop.example.com/' || event_type || '?id=' || event_id AS page_url,
        CASE event_type
            WHEN 'purchase' THEN 'Cat' || (user_id % 5) || ';item;1;'
                || CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) || ';200|201, Extra;e2;2;1.25'
            WHEN 'view' THEN 'Cat;item;1;;'
        END AS product_list,
        CASE event_id % 7
            WHEN 0 THEN 'http://www.google.com/search?hl=en&q=Word+' || (k % 5)
            WHEN 1 THEN 'http://search.yahoo.com/search?p=word%20' || (k % 5) || '&q=zzz'
            WHEN 2 THEN 'http://www.bing.com/search?q=' || CASE WHEN k % 3 = 0 THEN '' ELSE 'Zune' END
            WHEN 3 THEN 'http://shop.example.com/cart/?q=inside'
            WHEN 4 THEN 'http://notgoogle.com/?q=x'
            WHEN 5 THEN '   '
        END AS referrer
    FROM numbered
),
trimmed AS (
    SELECT hit_time_gmt, date_time, trim(user_agent) AS user_agent, trim(ip) AS ip,
        trim(event_list) AS event_list, trim(geo_city) AS geo_city,
        trim(geo_region) AS geo_region, trim(geo_country) AS geo_country,
        trim(pagename) AS pagename, trim(page_url) AS page_url,
        trim(product_list) AS product_list, trim(referrer) AS referrer
    FROM hits
),
all_hits AS (
    SELECT * REPLACE (
        nullif(event_list, '') AS event_list,
        nullif(product_list, '') AS product_list,
        nullif(referrer, '') AS referrer)
    FROM trimmed
),
product_entries AS (
    SELECT * FROM (
        SELECT *, trim(unnest(string_split(product_list, ','))) AS product_entry
        FROM all_hits WHERE product_list IS NOT NULL)
    WHERE product_entry <> ''
),
product_level AS (
    SELECT * EXCLUDE (product_list, product_entry),
        string_split(product_entry, ';')[1] AS product_category,
        string_split(product_entry, ';')[2] AS product_name,
        TRY_CAST(string_split(product_entry, ';')[3] AS INTEGER) AS product_quantity,
        TRY_CAST(string_split(product_entry, ';')[4] AS DOUBLE) AS product_total_revenue,
        nullif(string_split(product_entry, ';')[5], '') AS product_custom_events
    FROM product_entries
),
hosts AS (
    SELECT *, lower(regexp_extract(referrer, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM all_hits
),
engines AS (
    SELECT *, CASE
            WHEN host = 'google.com' OR host LIKE '%.google.com' THEN 'google.com'
            WHEN host = 'bing.com' OR host LIKE '%.bing.com' THEN 'bing.com'
            WHEN host = 'yahoo.com' OR host LIKE '%.yahoo.com' THEN 'yahoo.com'
        END AS search_engine_domain
    FROM hosts
),
origins AS (
    SELECT * EXCLUDE (host), lower(trim(url_decode(replace(nullif(coalesce(
            CASE WHEN search_engine_domain = 'yahoo.com'
                THEN nullif(regexp_extract(referrer, '[?&]p=([^&#]+)', 1), '') END,
            CASE WHEN search_engine_domain IS NOT NULL
                THEN nullif(regexp_extract(referrer, '[?&]q=([^&#]+)', 1), '') END
        ), ''), '+', ' ')))) AS search_keyword
    FROM engines
),
ranked AS (
    SELECT *, rank() OVER (PARTITION BY ip ORDER BY hit_time_gmt NULLS FIRST) AS hit_rank
    FROM origins
),
sessions AS (
    SELECT ip, search_engine_domain, search_keyword FROM (
        SELECT *, row_number() OVER (
                PARTITION BY ip ORDER BY search_engine_domain, search_keyword) AS n
        FROM ranked
        WHERE hit_rank = 1 AND search_engine_domain IS NOT NULL AND search_keyword <> '')
    WHERE n = 1
),
purchases AS (
    SELECT ip, product_name, product_total_revenue FROM product_level
    WHERE list_contains(list_transform(string_split(event_list, ','), lambda x: trim(x)), '1')
        AND product_total_revenue > 0
),
attributed AS (
    SELECT s.ip, search_engine_domain, search_keyword, product_name,
        coalesce(product_total_revenue, 0.0) AS product_total_revenue
    FROM sessions s LEFT JOIN purchases p ON s.ip = p.ip
),
searches AS (
    SELECT ip, hit_time_gmt, search_engine_domain, search_keyword FROM origins
    WHERE search_keyword <> '' AND ip IS NOT NULL AND hit_time_gmt IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY ip, hit_time_gmt ORDER BY search_engine_domain, search_keyword) = 1
),
bought AS (
    SELECT ip, hit_time_gmt, product_name, product_total_revenue FROM product_level
    WHERE list_contains(list_transform(string_split(event_list, ','), lambda x: trim(x)), '1')
        AND product_total_revenue > 0
),
purchased AS (
    SELECT page_url, product_total_revenue FROM product_level
    WHERE list_contains(list_transform(string_split(event_list, ','), lambda x: trim(x)), '1')
        AND product_total_revenue > 0
),
last_search AS (
    SELECT b.*, s.search_engine_domain, s.search_keyword,
        CAST(s.hit_time_gmt AS BIGINT) AS search_time
    FROM bought b ASOF LEFT JOIN searches s
        ON b.ip = s.ip AND b.hit_time_gmt >= s.hit_time_gmt
),
numbered_hits AS (
    SELECT *, CAST(sum(opens) OVER (
            PARTITION BY ip ORDER BY hit_time_gmt RANGE UNBOUNDED PRECEDING) AS BIGINT)
        AS session_number
    FROM (
        SELECT *, CASE WHEN hit_time_gmt - lag(hit_time_gmt) OVER (
                PARTITION BY ip ORDER BY hit_time_gmt) <= 12 THEN 0 ELSE 1 END AS opens
        FROM origins)
),
offers AS (
    SELECT page_url AS offer, ip, CAST(hit_time_gmt AS BIGINT) AS starts,
        CAST(hit_time_gmt + pow(CAST(regexp_extract(page_url, 'id=([0-9]+)', 1) AS BIGINT) % 11, 3)
            AS BIGINT) AS ends
    FROM all_hits WHERE event_list = '11'
),
revenue AS (
    SELECT search_engine_domain, search_keyword, round(sum(product_total_revenue), 2) AS revenue
    FROM attributed GROUP BY ALL
)
"""

_REPORT_SQL = """
SELECT search_engine_domain AS "Search Engine Domain", search_keyword AS "Search Keyword",
    revenue AS "Revenue"
FROM revenue ORDER BY revenue DESC, 1, 2
"""


_SESSIONS_SQL = """
SELECT ip, session_number, session_start, session_end, n_hits,
    entry.search_engine_domain AS search_engine_domain,
    entry.search_keyword AS search_keyword, coalesce(revenue, 0.0) AS revenue
FROM (
    SELECT ip, session_number, CAST(min(hit_time_gmt) AS BIGINT) AS session_start,
        CAST(max(hit_time_gmt) AS BIGINT) AS session_end, count(*) AS n_hits
    FROM numbered_hits GROUP BY ALL)
LEFT JOIN (
    SELECT h.ip, h.session_number,
        min({'search_engine_domain': search_engine_domain,
             'search_keyword': search_keyword}) AS entry
    FROM numbered_hits h JOIN (
        SELECT ip, session_number, min(hit_time_gmt) AS first_time
        FROM numbered_hits GROUP BY ALL) f
        ON h.ip = f.ip AND h.session_number = f.session_number
            AND h.hit_time_gmt = f.first_time
    WHERE search_keyword <> '' GROUP BY ALL) USING (ip, session_number)
LEFT JOIN (
    SELECT n.ip, n.session_number, round(sum(b.product_total_revenue), 2) AS revenue
    FROM bought b JOIN (
        SELECT DISTINCT ip, hit_time_gmt, session_number FROM numbered_hits) n
        ON b.ip = n.ip AND b.hit_time_gmt = n.hit_time_gmt
    GROUP BY ALL) USING (ip, session_number)
"""


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL."""
    on_hits = {
        # the file holds whole seconds, and an empty field reads as NULL
        "read_hits_tsv": """
            SELECT * REPLACE (
                date_trunc('second', date_time) AS date_time,
                nullif(event_list, '') AS event_list)
            FROM hits
        """,
        "conformed_roundtrip": "SELECT * FROM all_hits",
        "product_roundtrip": "SELECT * FROM product_level",
        "csv_copy_roundtrip": """
            SELECT * REPLACE (date_trunc('millisecond', date_time) AS date_time) FROM product_level
        """,
        "report_tab_roundtrip": _REPORT_SQL,
        "trim_strings": "SELECT * FROM trimmed",
        "blank_to_null": "SELECT ip, hit_time_gmt, event_list, product_list, referrer FROM all_hits",
        "clean_hits": "SELECT * FROM all_hits",
        "product_hits": "SELECT * FROM all_hits WHERE product_list IS NOT NULL",
        "product_entries": "SELECT ip, hit_time_gmt, event_list, product_entry FROM product_entries",
        "product_level": "SELECT * FROM product_level",
        "search_engine": "SELECT ip, hit_time_gmt, referrer, search_engine_domain FROM origins",
        "search_keyword": """
            SELECT ip, hit_time_gmt, referrer, search_engine_domain, search_keyword FROM origins
        """,
        "hit_rank": "SELECT ip, hit_time_gmt, referrer, page_url, hit_rank FROM ranked",
        "first_hits": """
            SELECT * EXCLUDE (search_engine_domain, search_keyword, hit_rank)
            FROM ranked WHERE hit_rank = 1
        """,
        "session_search_origin": "SELECT * FROM sessions",
        "purchase_hits": """
            SELECT * FROM all_hits
            WHERE list_contains(list_transform(string_split(event_list, ','), lambda x: trim(x)), '1')
        """,
        "purchase_revenue": "SELECT * FROM purchases",
        "attributed_purchases": "SELECT * FROM attributed",
        "revenue_by_keyword": "SELECT * FROM revenue",
        "search_keyword_performance": _REPORT_SQL,
        "asof_attribution": "SELECT * FROM last_search",
        "asof_revenue_by_keyword": """
            SELECT search_engine_domain, search_keyword,
                round(sum(product_total_revenue), 2) AS revenue, count(*) AS n_products
            FROM last_search GROUP BY ALL
        """,
        "gap_sessions": "SELECT ip, hit_time_gmt, page_url, session_number FROM numbered_hits",
        "gap_session_report": _SESSIONS_SQL,
        "offer_hits": """
            SELECT h.ip, h.hit_time_gmt, h.page_url, o.offer, o.starts, o.ends
            FROM all_hits h JOIN offers o
                ON h.ip = o.ip AND h.hit_time_gmt BETWEEN o.starts AND o.ends
        """,
        "offer_report": """
            SELECT o.*, count(DISTINCT h.page_url) AS n_hits,
                coalesce(round(sum(b.product_total_revenue), 2), 0.0) AS revenue
            FROM all_hits h
            JOIN offers o ON h.ip = o.ip AND h.hit_time_gmt BETWEEN o.starts AND o.ends
            LEFT JOIN (SELECT page_url, product_total_revenue FROM purchased) b USING (page_url)
            GROUP BY ALL
        """,
        "stream_product_level": """
            SELECT * REPLACE (date_trunc('second', date_time) AS date_time) FROM product_level
        """,
        "stream_sessions": f"SELECT * EXCLUDE (session_number) FROM ({_SESSIONS_SQL})",
        "stage_row_counts": """
            SELECT 'raw_hits' AS stage, count(*) AS n_rows FROM hits
            UNION ALL SELECT 'all_hits', count(*) FROM all_hits
            UNION ALL SELECT 'product_level', count(*) FROM product_level
            UNION ALL SELECT 'sessions', count(*) FROM sessions
            UNION ALL SELECT 'purchases', count(*) FROM purchases
            UNION ALL SELECT 'report', count(*) FROM revenue
        """,
        "conform_job": """
            SELECT 'all_hits' AS table_name, count(*) AS n_rows,
                count(DISTINCT ip) AS n_visitors, count(referrer) AS n_measured FROM all_hits
            UNION ALL SELECT 'all_hits_csv', count(*), count(DISTINCT ip), count(referrer)
                FROM all_hits
            UNION ALL SELECT 'product_level', count(*), count(DISTINCT ip),
                count(product_total_revenue) FROM product_level
        """,
        "curate_job": _REPORT_SQL,
    }
    on_pages = {
        "url_host_counts": r"""
            SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host,
                count(*) AS n_pages
            FROM pages GROUP BY ALL
        """,
        "url_param_counts": r"""
            SELECT nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS page,
                nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') AS ref,
                nullif(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), '') AS utm_source,
                count(*) AS n_pages
            FROM pages GROUP BY ALL
        """,
    }
    with_tables = {name: _TABLES_SQL + sql for name, sql in on_hits.items()}
    return with_tables | on_pages | (_llm.oracle_sql() if _llm else {})
