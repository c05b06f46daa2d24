"""Search engine and keyword behind a referrer."""
from collections.abc import Mapping, Sequence
from itertools import groupby

from pyspark.sql import Column, functions as F

from clickrev.fixed_values import SEARCH_ENGINES
from clickrev.functions.url import form_decode, raw_param_of

Engines = Mapping[str, Sequence[str]]

# Everything Unicode counts as white space, and the four ASCII separators.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def search_engine(host: Column, engines: Engines = SEARCH_ENGINES) -> Column:
    """The domain of ``engines`` that ``host`` equals or is a subdomain of, else NULL.

    ``host`` is a lower-case host name such as :func:`clickrev.functions.url_host`
    gives. Its last labels are looked up among the domains; domains of several
    lengths are tried in the order of the table, and the first match wins. Each
    look-up names ``host`` once: Spark repeats the expression behind a column for
    every mention when it pushes a filter on the result down.
    """
    if not engines:
        raise ValueError("the table of search engines is empty")
    found = []
    for dots, domains in groupby(engines, key=lambda domain: domain.count(".")):
        itself = [F.lit(domain) for domain in domains for _ in ("key", "value")]
        last_labels = F.substring_index(host, ".", -(dots + 1))
        found.append(F.try_element_at(F.create_map(*itself), last_labels))
    return F.coalesce(*found)


def search_keyword(
    clean_url: Column, engine: Column, engines: Engines = SEARCH_ENGINES
) -> Column:
    """The keyword in a URL: first present parameter of ``engine``, decoded, stripped, lower case.

    ``clean_url`` is what :func:`clickrev.functions.without_line_breaks` gives.
    NULL when there is no engine or no parameter. A parameter holding only blanks
    is present and gives an empty string.
    """
    domains_by_params: dict[tuple[str, ...], list[str]] = {}
    for domain, params in engines.items():
        domains_by_params.setdefault(tuple(params), []).append(domain)

    if not domains_by_params:
        raise ValueError("the table of search engines is empty")
    # an engine is in one case only; the others are NULL
    cases = [
        F.when(
            engine.isin(domains), F.coalesce(*[raw_param_of(clean_url, name) for name in params])
        )
        for params, domains in domains_by_params.items()
    ]
    return F.lower(F.trim(form_decode(F.coalesce(*cases)), F.lit(_BLANKS)))
