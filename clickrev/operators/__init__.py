"""DataFrame operators: each maps DataFrames to a DataFrame and stays lazy."""
from clickrev.operators.attribution import (
    attributed_purchases,
    purchase_hits,
    purchase_revenue,
    revenue_by_keyword,
    search_keyword_performance,
)
from clickrev.operators.clean import blank_to_null, clean_hits, trim_strings
from clickrev.operators.intervals import interval_join, offer_hits, offer_report
from clickrev.operators.products import product_entries, product_hits, product_level
from clickrev.operators.ranking import first_hits, rank_hits
from clickrev.operators.sessions import session_search_origin, with_search_origin
from clickrev.operators.timeline import (
    as_of,
    asof_attribution,
    asof_revenue_by_keyword,
    gap_session_report,
    gap_sessions,
    session_numbers,
)

__all__ = [
    "as_of",
    "asof_attribution",
    "asof_revenue_by_keyword",
    "attributed_purchases",
    "blank_to_null",
    "clean_hits",
    "first_hits",
    "gap_session_report",
    "gap_sessions",
    "interval_join",
    "offer_hits",
    "offer_report",
    "product_entries",
    "product_hits",
    "product_level",
    "purchase_hits",
    "purchase_revenue",
    "rank_hits",
    "revenue_by_keyword",
    "search_keyword_performance",
    "session_numbers",
    "session_search_origin",
    "trim_strings",
    "with_search_origin",
]
