r"""URL parts as native column expressions.

``parse_url`` is too strict for referrers: it gives up on a pipe or a blank in
the query and on an underscore in the host, both common in real traffic. The
rules here are those of a lenient URL splitter:

* leading control characters and blanks are skipped; tab, CR and LF are deleted
  wherever they stand;
* the authority follows ``//`` after an optional scheme and ends at ``/ ? #``;
  user info and port are not part of the host;
* an authority with square brackets (IPv6), or with a character that Unicode
  compatibility normalisation would turn into one of ``/ ? # @ :``, has no host;
* the query lies between the first ``?`` and ``#``; parameters are split by ``&``
  only, empty values do not count, and the first one of a name wins.
"""
from pyspark.sql import Column, functions as F

# Characters whose NFKC form holds one of / ? # @ : . The range in front keeps the
# test cheap: plain characters fail it at once.
_LOOKALIKE = r"[\x{2047}-\x{ff20}&&[⁇⁈⁉℀℁℅℆⩴︓︖﹕﹖﹟﹫＃／：？＠]]"
_HOST = (
    r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"
    rf"(?![^/?#]*{_LOOKALIKE})"
    r"(?:[^/?#\[\]]*@)?([^/?#\[\]@:]+)(?::[^/?#\[\]@]*)?(?:[/?#]|\z)"
)


def without_line_breaks(url: Column) -> Column:
    """``url`` without the tabs and line breaks a lenient splitter deletes."""
    for char in "\t\r\n":  # plain replaces, three times as fast as one pattern here
        url = F.replace(url, F.lit(char), F.lit(""))
    return url


def _captured(text: Column, pattern: str) -> Column:
    """What the group of an anchored ``pattern`` captures, NULL without a match."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


def host_of(clean_url: Column) -> Column:
    """Lower-case host of a URL without line breaks, NULL when there is none."""
    return F.lower(_captured(clean_url, _HOST))


def url_host(url: Column) -> Column:
    """Lower-case host of ``url``, NULL when there is none."""
    return host_of(without_line_breaks(url))


def _percent_encoded(char: str) -> str:
    """Pattern for ``char`` written as percent escapes, hex digits in either case."""
    digits = "".join(f"%{byte:02x}" for byte in char.encode("utf-8"))
    return "".join(f"[{d}{d.upper()}]" if d in "abcdef" else d for d in digits)


def _name_pattern(name: str) -> str:
    """Pattern for a parameter name, each character plain or percent-encoded."""
    pattern = ""
    for char in name:
        spellings = [_percent_encoded(char)]
        if char == " ":
            spellings.append(r"\+")
        elif char not in "&#=%+":
            spellings.append(rf"\x{{{ord(char):x}}}")
        pattern += f"(?:{'|'.join(spellings)})"
    return pattern


def raw_param_of(clean_url: Column, name: str) -> Column:
    """First non-empty value of parameter ``name``, still encoded; NULL if absent."""
    pattern = rf"^[^?#]*\?(?:[^#]*?&)??{_name_pattern(name)}=([^&#]+)"
    return _captured(clean_url, pattern)


def form_decode(text: Column) -> Column:
    """Decode ``+`` and percent escapes as UTF-8; a stray ``%`` stays as it is."""
    return F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def query_param(url: Column, name: str) -> Column:
    """First non-empty value of query parameter ``name``, decoded."""
    return form_decode(raw_param_of(without_line_breaks(url), name))
