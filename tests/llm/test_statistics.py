"""Style trees against plain entropies, classes of rows without ids, BM25, and clashing names."""
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickrev.llm import dom, site_tree
from clickrev.llm.dom import parse
from clickrev.llm.jaccard_join import one_of_each, similarity_classes
from clickrev.llm.packing import Bm25, content_keys, corpus_of, key_ranks, pack
from clickrev.llm.site_tree import (
    CONTENT_WEIGHT,
    LOW_OUTSIDE,
    MIN_PAGES,
    article_digests,
    extract,
    importance_of,
    low_importance_paths,
    path_digests,
)


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abdeilmnorstu", k=rng.randint(2, 8))) for _ in range(words))


# --- style trees ---------------------------------------------------------------


def site(host, count, phrases):
    """Pages whose menus, boxes and last lines say one of a few things."""
    rng = random.Random(host)
    pool = [prose(k, 4) for k in range(phrases)]
    for k in range(count):
        menu, box, last = (rng.choice(pool) for _ in range(3))
        yield (
            f"http://{host}/{k}",
            f"<div class=x1><nav>{menu}</nav><div class=q7>{box}</div><article><h1>{prose(f'{host}{k}', 3)}</h1>"
            f"<p>{prose(f'{host}-{k}', 30)}</p></article></div><footer>{last}</footer>",
            f"{prose(f'{host}{k}', 3)} {prose(f'{host}-{k}', 30)}",
        )


@pytest.fixture(scope="module")
def sites(spark):
    pages = [*site("big.example", 300, 12), *site("small.example", 10, 12)]
    rows = [(k, url, html) for k, (url, html, _) in enumerate(pages)]
    return pages, spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_importance_alone_finds_the_main_text(sites, monkeypatch):
    """On a host with statistics no list of tags or names, and no article rule, is needed."""
    pages, table = sites
    low = frozenset(row.path for row in low_importance_paths(table).collect() if row.host == "big.example")
    assert low
    monkeypatch.setattr(dom, "_DROPPED_TAGS", frozenset())
    monkeypatch.setattr(dom, "_DROPPED_NAMES", frozenset())
    monkeypatch.setattr(dom, "_DROPPED_ROLES", frozenset())
    monkeypatch.setattr(site_tree, "content_roots", lambda page: [])
    dom._kind_of.cache_clear()
    try:
        for _, html, text in pages[:300]:
            assert site_tree.main_text(html, low) == text
    finally:
        dom._kind_of.cache_clear()


def test_both_hosts_give_the_main_text(sites):
    pages, table = sites
    found = {row.page_id: row.text for row in extract(table).collect()}
    assert all(found[k] == text for k, (*_, text) in enumerate(pages))


def test_low_paths_against_plain_entropies(spark, sites):
    pages, table = sites
    seen = defaultdict(lambda: (set(), set()))
    for url, html, _ in pages:
        page = parse(html)
        article = article_digests(page)[0]
        for path, content, layout in path_digests(page):
            contents, layouts = seen[site_tree.host_of(url), path]
            contents.add((content, article))
            layouts.add((layout, article))
    wanted = set()
    for key, (contents, layouts) in seen.items():
        counts = [list(Counter(d for d, _ in rows).values()) for rows in (contents, layouts)]
        if sum(counts[0]) >= MIN_PAGES and importance_of(counts) < LOW_OUTSIDE:
            wanted.add(key)
    found = {(row.host, row.path) for row in low_importance_paths(table).collect()}
    # paths inside the article are told by what they say, and none is repeated here
    assert found == wanted and {host for host, _ in found} == {"big.example"}


def test_importance_of_a_path():
    alike, different = [8], [1] * 8
    assert importance_of([different, different]) == 1.0
    assert importance_of([alike, alike]) == 0.0
    assert importance_of([different, alike]) == pytest.approx(CONTENT_WEIGHT)
    # two of four in each half: the chance that two agree is 12 of 56
    assert importance_of([[4, 4], alike]) == pytest.approx(CONTENT_WEIGHT * math.log(56 / 24) / math.log(8))


def test_copies_of_an_article_do_not_make_it_boilerplate(spark):
    rows = [(k, "http://h.example/a", f"<article><p>{prose(0, 20)}</p></article><footer>x</footer>") for k in range(30)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("clash"))
    assert {row.text for row in extract(table.withColumn("low", F.lit(1))).collect()} == {prose(0, 20)}


# --- classes ---------------------------------------------------------------------


def near(seed, changed):
    words = prose(seed, 120).split()
    words[changed] = "changed"
    return " ".join(words)


def test_rows_without_ids_keep_their_links(spark):
    rows = [(None, near(1, 5)), (None, near(1, 60)), (4, near(1, 100)), (None, None), (9, prose(2, 50))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = Counter((r.doc_id, r.class_id, r.n_links) for r in similarity_classes(docs).collect())
    assert found == Counter([(None, 4, 2), (None, 4, 2), (4, 4, 2), (None, None, 0), (9, 9, 0)])


def test_one_row_of_each_class_stays(spark):
    a, b, c = near(1, 5), near(1, 60), near(1, 100)
    rows = [(7, a), (7, a), (7, b), (8, c), (None, a), (None, prose(3, 40)), (None, prose(3, 40)), (5, None), (5, None)]
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id bigint, text string, _id string, _hash int")
    found = one_of_each(docs)
    assert found.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in found.collect())
    (first,) = [row for row in kept if row[0] == 7]
    assert first[1] in (a, b) and kept == Counter([first, (None, prose(3, 40)), (5, None), (5, None)])


def test_pipeline_stages_with_clashing_names(spark):
    rows = [(k, prose(k, 30), "en", "s", 1, "x", 0.5, "y") for k in range(6)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, lang_pred string, score double, _lang string"
    )
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns and kept.count() == 6


# --- packing -----------------------------------------------------------------------


def test_bm25_against_plain_sums():
    rng = np.random.default_rng(5)
    documents = [rng.integers(0, 40, rng.integers(1, 60)).astype("<u4") for _ in range(30)]
    corpus, index = corpus_of(documents), Bm25(documents)
    n, mean = len(documents), sum(map(len, documents)) / len(documents)
    with_term = Counter(t for d in documents for t in set(d.tolist()))
    assert corpus.documents == n and corpus.tokens == sum(map(len, documents))
    for seed in range(n):
        scores = index.scores(seed)
        for other, document in enumerate(documents):
            counts = Counter(document.tolist())
            plain = sum(
                max(0.0, math.log((n - with_term[t] + 0.5) / (with_term[t] + 0.5)))
                * counts[t] * 2.2 / (counts[t] + 1.2 * (0.25 + 0.75 * len(document) / mean))
                for t in set(documents[seed].tolist())
            )
            assert scores[other] == pytest.approx(plain)


def test_keys_are_ids_of_the_document_and_copies_share_them():
    ranks = key_ranks(100)
    terms = np.array([0, 3, 50, 99])
    keys = content_keys(terms, ranks)
    assert set(keys) <= {3, 50, 99} and keys == content_keys(terms, ranks)
    assert content_keys(np.array([0]), ranks) == [-1] * len(ranks)


def test_neighbours_fill_a_window():
    """A seed's window goes on with the document that shares its rare terms."""
    seed, other, friend = np.full(10, 7, "<u4"), np.full(10, 3, "<u4"), np.array([7] * 6 + [2] * 4, "<u4")
    filler = [np.full(4, 20 + k, "<u4") for k in range(8)]
    order = list(dict.fromkeys(piece[0] for piece in pack([seed, other, friend, *filler], window=30)))
    assert order[:2] == [0, 2]
