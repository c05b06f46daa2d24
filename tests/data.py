"""Small invented tables for the tests."""
from pyspark.sql import types as T

from clickrev.fixed_values import RAW_HIT_SCHEMA

HIT_DEFAULTS = {
    "hit_time_gmt": 1000,
    "date_time": None,
    "user_agent": "Agent",
    "ip": "10.1.1.1",
    "event_list": None,
    "geo_city": "Springfield",
    "geo_region": "OR",
    "geo_country": "US",
    "pagename": "Home",
    "page_url": "http://shop.example.com",
    "product_list": None,
    "referrer": None,
}


def hits(spark, *rows):
    """Hits from dicts; columns left out take their default."""
    values = [tuple((HIT_DEFAULTS | row).values()) for row in rows]
    return spark.createDataFrame(values, RAW_HIT_SCHEMA)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def column(df, name):
    return [row[name] for row in df.select(name).collect()]


SESSIONS = "ip string, search_engine_domain string, search_keyword string"
PURCHASES = "ip string, product_name string, product_total_revenue double"

GOOGLE = "http://www.google.com/search?hl=en&q="
BING = "http://www.bing.com/search?q="
YAHOO = "http://search.yahoo.com/search?p="
SHOP = "http://shop.example.com/cart/"

ASK = "http://uk.ask.com/web?q="
AOL = "http://search.aol.com/aol/search?query="
DUCK = "https://duckduckgo.com/?q="

# A garden shop. Two visitors search for the same words in different case and coding, one
# enters on a product page, one comes from inside the shop, one never buys a single item.
SHOP_VISITS = [
    {"ip": "10.2.0.7", "hit_time_gmt": 50, "referrer": ASK + "Garden+Hose", "event_list": "2",
     "product_list": "Tools;Hose 20m;1;;"},
    {"ip": "10.2.0.4", "hit_time_gmt": 55, "referrer": ASK + "garden%20hose"},
    {"ip": "10.2.0.9", "hit_time_gmt": 61, "referrer": AOL + "Rake"},
    {"ip": "10.2.0.6", "hit_time_gmt": 64, "referrer": DUCK + "lamp+oil&ia=web"},
    {"ip": "10.2.0.5", "hit_time_gmt": 70, "referrer": SHOP},
    {"ip": "10.2.0.9", "hit_time_gmt": 75, "referrer": SHOP, "event_list": "2,10",
     "product_list": "Tools;Rake;1;;,Tools;Gloves;1;;"},
]
SHOP_SESSIONS = [
    ("10.2.0.4", "ask.com", "garden hose"),
    ("10.2.0.6", "duckduckgo.com", "lamp oil"),
    ("10.2.0.7", "ask.com", "garden hose"),
    ("10.2.0.9", "aol.com", "rake"),
]
SINGLE_ORDERS = [
    {"ip": "10.2.0.7", "hit_time_gmt": 90, "referrer": SHOP, "event_list": "1",
     "product_list": "Tools;Hose 20m;2;37.5;"},
    {"ip": "10.2.0.9", "hit_time_gmt": 92, "referrer": SHOP, "event_list": "1",
     "product_list": "Tools;Rake;1;12.25;"},
    {"ip": "10.2.0.9", "hit_time_gmt": 97, "referrer": SHOP, "event_list": "12,1",
     "product_list": "Garden;Gloves;3;8;"},
    {"ip": "10.2.0.4", "hit_time_gmt": 99, "referrer": SHOP, "event_list": "1",
     "product_list": "Garden;Sprinkler;1;21.75;"},
    {"ip": "10.2.0.5", "hit_time_gmt": 101, "referrer": SHOP, "event_list": "1",
     "product_list": "Garden;Bench;1;140;"},
]
SINGLE_ORDER_REPORT = [
    ("ask.com", "garden hose", 59.25),
    ("aol.com", "rake", 20.25),
    ("duckduckgo.com", "lamp oil", 0.0),
]
# Two products per order, with and without the last semicolons.
DOUBLE_ORDERS = [
    {"ip": "10.2.0.4", "hit_time_gmt": 90, "referrer": SHOP, "event_list": "1",
     "product_list": "Garden;Sprinkler;1;21.75,Tools;Hose 20m;1;18.5;"},
    {"ip": "10.2.0.9", "hit_time_gmt": 95, "referrer": SHOP, "event_list": "1",
     "product_list": "Tools;Rake;1;12.25;,Garden;Gloves;3;8"},
    {"ip": "10.2.0.6", "hit_time_gmt": 99, "referrer": SHOP, "event_list": "1",
     "product_list": "Garden;Lamp;2;70.5;,Garden;Oil;4;9.5;300"},
]
DOUBLE_ORDER_REPORT = [
    ("duckduckgo.com", "lamp oil", 80.0),
    ("ask.com", "garden hose", 40.25),
    ("aol.com", "rake", 20.25),
]
