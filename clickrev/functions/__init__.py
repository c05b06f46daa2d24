"""Column functions: everything here maps Column to Column with Spark built-ins."""
from clickrev.functions.events import has_event
from clickrev.functions.numbers import finite_double, whole_number
from clickrev.functions.orders import order_total
from clickrev.functions.referrer import search_engine, search_keyword
from clickrev.functions.url import host_of, query_param, url_host, without_line_breaks

__all__ = [
    "finite_double",
    "has_event",
    "host_of",
    "order_total",
    "query_param",
    "search_engine",
    "search_keyword",
    "url_host",
    "whole_number",
    "without_line_breaks",
]
