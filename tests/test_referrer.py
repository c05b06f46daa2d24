"""Engine and keyword against Python's own URL parser."""
import random
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import functions as F

from clickrev.fixed_values import SEARCH_ENGINES
from clickrev.functions import query_param, url_host
from clickrev.operators import with_search_origin
from data import column, frame


def origins(spark, urls, engines=SEARCH_ENGINES):
    df = frame(spark, "n int, referrer string", *enumerate(urls))
    found = with_search_origin(df, engines=engines).orderBy("n").collect()
    return [(row.search_engine_domain, row.search_keyword) for row in found]


def expected_origin(url):
    """What a URL parser says; None where it rejects the URL."""
    try:
        split = urlsplit(url or "")
        host = (split.hostname or "").lower()
    except ValueError:
        return None, None
    labels = host.split(".")
    suffixes = {".".join(labels[i:]) for i in range(len(labels))}
    engine = next((domain for domain in SEARCH_ENGINES if domain in suffixes), None)
    values = parse_qs(split.query)
    names = [name for name in SEARCH_ENGINES.get(engine, []) if name in values]
    return engine, values[names[0]][0].strip().lower() if names else None


ORIGINS = [
    # a keyword is stripped and in lower case, whatever its coding
    ("https://www.google.com/search?q=%20Tin%20Opener%20", "google.com", "tin opener"),
    ("https://google.com/search?client=z&q=tin+opener#top", "google.com", "tin opener"),
    ("https://duckduckgo.com/?q=%C3%89t%C3%A9", "duckduckgo.com", "été"),
    ("http://cn.bing.com/search?form=Q&q=47+mm", "bing.com", "47 mm"),
    ("http://www.msn.com/?x=1&y=2&q=sieve", "msn.com", "sieve"),
    ("http://de.ask.com/web?l=dir&q=a%2Bb", "ask.com", "a+b"),
    # engines with two parameters: the first of the table that is there
    ("http://search.aol.com/s?query=ladle", "aol.com", "ladle"),
    ("http://search.aol.com/s?query=ladle&q=whisk", "aol.com", "whisk"),
    ("http://www.baidu.com/s?word=b&wd=a", "baidu.com", "a"),
    ("http://m.yahoo.com/?q=grater", "yahoo.com", "grater"),
    ("http://m.yahoo.com/?p=&q=grater", "yahoo.com", "grater"),
    ("http://m.yahoo.com/?p=%09&q=grater", "yahoo.com", ""),
    # an engine without a keyword, and hosts that are none
    ("http://news.google.com/topics", "google.com", None),
    ("http://www.google.co.uk/search?q=x", None, None),
    ("http://mybing.com/?q=x", None, None),
    ("http://bing.com.example.org/?q=x", None, None),
    ("http://example.org/bing.com/?q=x", None, None),
    ("http://example.org/?to=http://bing.com/?q=x", None, None),
    ("", None, None),
    (None, None, None),
]


def test_search_origin(spark):
    found = origins(spark, [url for url, _, _ in ORIGINS])
    assert [(url, *origin) for (url, _, _), origin in zip(ORIGINS, found)] == ORIGINS


TRICKY = [
    "HTTP://WWW.GOOGLE.COM:80/search?Q=no&q=Yes",
    "//google.com?q=scheme-less",
    "google.com/?q=no-slashes",
    "http:google.com?q=one",
    "http://user:pw@www.google.com:8080/?q=u",
    "http://a@b@google.com/?q=two+ats",
    "http://google.com@evil.example/?q=x",
    "http://google.com:80:90/?q=ports",
    "http://google.com#?q=fragment",
    "http://google.com?q=a#b",
    "http://google.com/#frag?q=x",
    "http://google.com/a?b?q=x",
    "http://google.com/?x?q=1&q=2",
    "http://google.com/?q=1&q=2",
    "http://google.com/?q=&q=2",
    "http://google.com/?q",
    "http://google.com/?q=a=b",
    "http://google.com/?aq=1&q=2",
    "http://google.com/?a=1;q=2",
    "http://google.com/?%71=encoded",
    "http://aol.com/?%71u%65r%79=encoded",
    "http://baidu.com/?w%6Frd=upper",
    "http://baidu.com/?w%6frd=lower",
    "http://google.com/?q=100%",
    "http://google.com/?q=%zz%41",
    "http://google.com/?q=%ff%fe",
    "http://google.com/?q=%C3",
    "http://google.com/?q=%25",
    "http://google.com/?q=%2B+%2b",
    "http://google.com/?q=a|b c",
    "http://google.com/?q=%E2%80%83wide%E3%80%80",
    "http://google.com/?q=%1Cx%1F",
    "http://google.com/?q=%C4%B0STANBUL",
    "http://google.com/?q=%CE%A3%CE%91%CE%A3",
    "http://my_host.google.com/?q=x",
    "http://.google.com/?q=x",
    "http://google.com./?q=x",
    "http://[google.com]/?q=x",
    "http://[::1]/?q=x",
    "http://[::1/?q=x",
    "http://x]@google.com/?q=x",
    "http://as\u212a.com/?q=kelvin",
    "http://b\u0130ng.com/?q=dotted",
    "http://\u2100@google.com/?q=lookalike",
    "http://google.com\uff0fx/?q=lookalike",
    "http://é.google.com/?q=x",
    "  \x01http://google.com/?q=blank",
    "ht\ttp://goo\ngle.com/?\rq=a\tb",
    "1http://google.com/?q=x",
    "h+t.t-p://google.com/?q=x",
    "ht_tp://google.com/?q=x",
    "http:///google.com?q=x",
    "http://?q=x",
    "http://",
    "://google.com/?q=x",
    "?q=x",
    "   ",
]


def test_tricky_urls_match_the_url_parser(spark):
    assert origins(spark, TRICKY) == [expected_origin(url) for url in TRICKY]


def test_brackets_leave_no_host(spark):
    # Python's parser changes its mind about brackets in user info between versions
    assert origins(spark, ["http://[v1.a]@google.com/?q=x", "http://[::1]@google.com/"]) == [
        (None, None),
        (None, None),
    ]


def random_url(rng):
    pick = rng.choice
    host = pick(["", "www.", "search.", "w", "a.b.", "x_y."]) + pick(
        [*SEARCH_ENGINES, "example.com", "google.co.uk", "GOOGLE.com", ""]
    )
    text = "".join(
        pick(["a", "Z", "%20", "+", "%41", "%c3%a9", "%zz", "%", "|", " ", ";", "é", "=", ".", "%e2", "?"])
        for _ in range(rng.randrange(5))
    )
    params = "&".join(
        pick(["q", "p", "wd", "word", "query", "Q", "%71", "aq", "q%", ""])
        + pick(["=", "=", "=", "", "=="])
        + pick([text, "", "x", "+"])
        for _ in range(rng.randrange(5))
    )
    return (
        pick(["http://", "https://", "HTTP://", "//", "", "ftp://", "http:/", " http://", "x y://"])
        + pick(["", "", "", "me@", "me:pw@", "a@b@"])
        + host
        + pick(["", "", ":80", ":", ":8:9"])
        + pick(["", "/", "/search", "/a;b", "/é"])
        + pick(["", "?", "?", "?", "#?"])
        + params
        + pick(["", "", "#top", "#?q=no", "?q=again"])
    )


def test_random_urls_match_the_url_parser(spark):
    rng = random.Random(20240101)
    urls = [random_url(rng) for _ in range(10_000)]
    expected = [expected_origin(url) for url in urls]
    assert sum(engine is not None for engine, _ in expected) > 2_000
    assert sum(bool(keyword) for _, keyword in expected) > 500
    found = origins(spark, urls)
    assert [case for case in zip(urls, found, expected) if case[1] != case[2]] == []


def test_the_engine_table_is_a_parameter(spark):
    engines = {"find.example": ["my term", "t&x"], "sub.find.example": ["never"]}
    urls = [
        "http://find.example/?my+term=A",
        "http://find.example/?my%20term=b",
        "http://sub.find.example/?t%26x=C",
        "http://google.com/?q=x",
    ]
    assert origins(spark, urls, engines) == [
        ("find.example", "a"),
        ("find.example", "b"),
        ("find.example", "c"),
        (None, None),
    ]


def test_the_first_match_of_the_table_wins(spark):
    urls = ["http://a.sub.find.example/?q=x", "http://sub.find.example/?q=x", "http://find.example/?q=x"]
    short_first = {"find.example": ["q"], "sub.find.example": ["q"], "other.example": ["q"]}
    assert origins(spark, urls, short_first) == [("find.example", "x")] * 3
    long_first = {"sub.find.example": ["q"], "find.example": ["q"]}
    assert origins(spark, urls, long_first) == [("sub.find.example", "x")] * 2 + [("find.example", "x")]


def test_host_and_parameter_of_any_url(spark):
    df = frame(spark, "url string", ("https://M.Example.net:443/en/1?page=2&ref=%58+y#top",), ("/p",))
    parts = df.select(
        url_host(F.col("url")).alias("host"),
        query_param(F.col("url"), "ref").alias("ref"),
        query_param(F.col("url"), "nope").alias("nope"),
    )
    assert [tuple(row) for row in parts.collect()] == [("m.example.net", "X y", None), (None,) * 3]


def test_the_input_columns_stay(spark):
    df = frame(spark, "id int, link string", (1, "http://bing.com/?q=x"))
    assert with_search_origin(df, "link").columns == [
        "id", "link", "search_engine_domain", "search_keyword",
    ]
    assert column(with_search_origin(df, "link"), "search_keyword") == ["x"]
