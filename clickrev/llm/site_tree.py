"""Main text of pages by site style trees.

Pages of one host share templates. Their element trees are merged by path, a path being the
chain of tags and classes from the root. For every path of a host two entropies are taken
over its different articles (copies of a whole article count once, so a host full of them
teaches nothing false): of the content, the whole text below the path, and of the
presentation, the labels of its children. An entropy is the collision entropy, the negative
logarithm of the chance that two of the articles agree there, estimated from pairs and so
without a bias for hosts of few pages; it is divided by its maximum, the logarithm of the
number of articles. The importance of a path is a weighted mean of the two, the content's
weight being the larger: a branch that says the same, or one of a few things, on every page has
little. On hosts with statistics, branches of low importance are removed from the whole tree
of each page, whatever their names.

Statistics of sameness cannot tell reader comments or a varying advert from an article, and
say nothing about a host with few pages. So what they leave is held against tags, roles and
class names that mark menus, headers, footers, sidebars, notices, adverts, forms and comments;
and on hosts without a path of low importance, what a page marks as its article is its main
text. Branches inside the article have statistics of the content alone, and a branch goes
only on pages where it says what at least ``MIN_PAGES`` different articles say at that path.
The article itself, and inline elements within running text, never go. Where statistics would
leave nothing of a page, they are not applied to it.

Null html, empty html and pages without text give empty text. Pages whose url is null
or names no host get no statistics. Very long pages are read whole. Other columns are not read.
"""
import math
import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import map_arrow, slices, staged
from clickrev.llm.dom import Element, Page, content_roots, in_running_text, parse, text_under

#: A path needs this many different articles before its statistics count.
MIN_PAGES = 4
#: Bounds of importance outside and inside the article.
LOW_OUTSIDE = 0.8
LOW_IMPORTANCE = 0.2
CONTENT_WEIGHT = 0.9
#: More low paths than this are joined by a shuffle instead of a broadcast.
BROADCAST_PATHS = 100_000
_ROWS_AT_ONCE = 256
#: Kind of the counts of content inside the article; 0 is content outside, 1 presentation.
_INSIDE = 2

_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def host_of(url: str | None) -> str | None:
    match = _HOST.match(url or "")
    return match[1].lower() if match else None


def _whole_digests(page: Page) -> dict[int, list[str]]:
    """By element, a digest that stands for the text below it; none where there is no text.

    A digest of digests, so deep trees stay linear.
    """
    whole: dict[int, list[str]] = {}
    for element in reversed(page.elements):  # children before their parents
        own = [text.strip() for *_, text in element.texts if text.strip()]
        for child in element.children:
            own += whole[id(child)]
        whole[id(element)] = [str(_digest("\n".join(own)))] if own else []
    return whole


def _below(roots: list[Element]) -> list[Element]:
    found: list[Element] = []
    waiting = list(reversed(roots))
    while waiting:
        element = waiting.pop()
        found.append(element)
        waiting.extend(reversed(element.children))
    return found


def path_digests(page: Page, whole: dict[int, list[str]] | None = None) -> list[tuple[int, int, int]]:
    """Per path outside the article: digests of path, content and presentation.

    The content of what holds the article includes it. Branches that tags or names mark as
    boilerplate are judged like all others.
    """
    whole = whole or _whole_digests(page)
    inside = {id(element) for element in _below(content_roots(page))}
    contents: dict[int, list[str]] = {}
    layouts: dict[int, list[str]] = {}
    for element in page.elements:
        if element.parent is not None and whole[id(element)] and id(element) not in inside:
            contents.setdefault(element.path, []).extend(whole[id(element)])
            layouts.setdefault(element.path, []).append(" ".join(child.label for child in element.children))
    return [
        (path, _digest("\n".join(texts)), _digest("\n".join(layouts[path])))
        for path, texts in contents.items()
    ]


def article_digests(page: Page, whole: dict[int, list[str]] | None = None) -> tuple[int, dict[int, int]]:
    """The digest of the article (the page without one), and per path inside it of its content."""
    whole = whole or _whole_digests(page)
    roots = content_roots(page)
    tops = {id(root) for root in roots}
    inside = _below(roots)
    never = {e.path for e in inside if id(e) in tops or in_running_text(e)}
    contents: dict[int, list[str]] = {}
    for element in inside:
        if whole[id(element)] and element.path not in never:
            contents.setdefault(element.path, []).extend(whole[id(element)])
    article = _digest("\n".join(digest for root in roots or [page.root] for digest in whole[id(root)]))
    return article, {path: _digest("\n".join(texts)) for path, texts in contents.items()}


def importance_of(counts: list[list[int]]) -> float:
    """Importance of a path from the numbers of articles with each content and each layout."""
    entropies = []
    for numbers in counts:
        n, pairs = sum(numbers), sum(k * (k - 1) for k in numbers)
        largest = math.log(n)
        entropies.append(min(1.0, math.log(n * (n - 1) / pairs) / largest) if pairs else 1.0)
    return CONTENT_WEIGHT * entropies[0] + (1 - CONTENT_WEIGHT) * entropies[1]


def low_importance_paths(pages: DataFrame) -> DataFrame:
    """``host, path`` of the branches to remove, from ``pages`` (url, html).

    For a branch inside the article, ``path`` is its path xor the digest of its content.
    Different articles are counted by (host, path, digest) before they meet by (host, path), so the
    pages of a large host do not meet in a task; their paths do, and a site has few.
    """

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _ROWS_AT_ONCE):
            rows = []
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                host = host_of(url)
                if host and html:
                    page = parse(html)
                    whole = _whole_digests(page)
                    article, inside = article_digests(page, whole)
                    for path, content, layout in path_digests(page, whole):
                        rows += [(host, path, 0, content, article), (host, path, 1, layout, article)]
                    rows += [(host, path, _INSIDE, content, article) for path, content in inside.items()]
            if rows:
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["host", "path", "kind", "digest", "article"],
                )

    schema = "host STRING, path BIGINT, kind INT, digest BIGINT, article BIGINT"
    counts = (
        map_arrow(pages, ["url", "html"], digests, schema)
        .distinct()
        .groupBy("host", "path", "kind", "digest")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = staged(pages.sparkSession, counts, "path-counts")
    inside = F.col("kind") == _INSIDE
    n = F.col("n").cast("double")
    by_kind = counts.groupBy("host", "path", "kind").agg(
        F.sum(n).alias("articles"), F.sum(n * (n - 1)).alias("pairs")
    )
    chance = F.col("pairs") / (F.col("articles") * (F.col("articles") - 1))
    entropy = F.when(chance > 0, F.least(F.lit(1.0), -F.log(chance) / F.log("articles"))).otherwise(1.0)
    weight = (
        F.when(inside, F.lit(1.0))
        .when(F.col("kind") == 0, F.lit(CONTENT_WEIGHT))
        .otherwise(F.lit(1 - CONTENT_WEIGHT))
    )
    low = (
        by_kind.filter(F.col("articles") >= MIN_PAGES)
        .groupBy("host", "path", inside.alias("inside"))
        .agg(F.sum(weight * entropy).alias("importance"))
        .filter(F.col("importance") < F.when(F.col("inside"), LOW_IMPORTANCE).otherwise(LOW_OUTSIDE))
    )
    repeated = counts.filter(inside & (F.col("n") >= MIN_PAGES)).select("host", "path", "digest")
    said = low.filter("inside").select("host", "path").join(repeated, ["host", "path"])
    return low.filter("NOT inside").select("host", "path").unionByName(
        said.select("host", F.col("path").bitwiseXOR(F.col("digest")).alias("path"))
    )


def main_text(html: str | None, low: frozenset[int] = frozenset()) -> str:
    """The main text of one page, given the digests of ``low_importance_paths`` for its host."""
    if not html:
        return ""
    page = parse(html)
    roots = content_roots(page)
    if low:
        removed = frozenset(path for path, content in article_digests(page)[1].items() if path ^ content in low)
        judged = text_under([page.root], low | removed)
        if judged:
            return judged
    return text_under(roots or [page.root])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of ``pages`` (page_id, url, html).

    The low paths, collected per host, are joined to the pages: broadcast if there are at
    most ``BROADCAST_PATHS``, else by a shuffle on the host that adaptive execution may split.
    """
    spark = pages.sparkSession
    low = staged(spark, low_importance_paths(pages), "low-paths")
    many = low.count()
    by_host = low.groupBy("host").agg(F.collect_set("path").alias("low"))
    host = F.lower(F.regexp_extract("url", _HOST.pattern, 1))
    wanted = pages.select("page_id", "url", "html")
    if many:
        by_host = F.broadcast(by_host) if many <= BROADCAST_PATHS else by_host
        wanted = wanted.withColumn("host", host).join(by_host, "host", "left").drop("host")
    else:
        wanted = wanted.withColumn("low", F.lit(None).cast("array<bigint>"))

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _ROWS_AT_ONCE):
            found = [
                main_text(html, frozenset(paths or ()))
                for html, paths in zip(
                    batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())],
                ["page_id", "url", "text"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return wanted.select("page_id", "url", "html", "low").mapInArrow(
        texts, f"page_id {kind}, url STRING, text STRING"
    )


def op10_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))
