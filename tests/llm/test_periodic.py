"""Runs against brute force, on small alphabets, real texts and odd rows."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickrev.llm.lyndon import lyndon_lengths, runs
from clickrev.llm.periodic import (
    collapse_runs,
    find_runs,
    gram_length,
    op11_lyndon_runs,
    runs_of_words,
    words_of_text,
)


def plain_lyndon(ranks):
    n = len(ranks)
    return [
        max(j - i for j in range(i + 1, n + 1) if all(ranks[i:j] < ranks[k:j] for k in range(i + 1, j)))
        for i in range(n)
    ]


def plain_runs(signs, least, times):
    """By trying every period; a negative sign is like no other."""
    n, out = len(signs), []
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and signs[i] == signs[i + p] and signs[i] not in (-1, None):
                i += 1
            length = i - start + p
            part = signs[start : start + length]
            smaller = any(part[q:] == part[:-q] for q in range(1, p))
            if i > start and length >= max(least, times * p) and not smaller:
                out.append((start, length, p))
            i = max(i, start + 1)
    return sorted(out, key=lambda run: (run[0], run[2]))


def sequences(seed, count, longest):
    rng = random.Random(seed)
    for _ in range(count):
        n, kinds = rng.randint(0, longest), rng.randint(1, 5)
        signs = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randint(0, 2)):
            if n > 4:
                a, p, end = rng.randrange(n), rng.randint(1, 6), rng.randint(0, n)
                for i in range(a + p, end):
                    signs[i] = signs[i - p]
        yield signs


def test_lyndon_lengths_are_those_of_all_prefixes():
    for signs in sequences(1, 800, 20):
        assert lyndon_lengths(signs) == plain_lyndon(signs)


@pytest.mark.parametrize("least,times", [(2, 2), (6, 4), (3, 3)])
def test_runs_are_those_of_all_periods(least, times):
    rng = random.Random(least)
    for signs in sequences(2, 500, 40):
        if signs and rng.random() < 0.3:
            signs[rng.randrange(len(signs))] = -1
        found = runs(np.array(signs, np.int64), least, times).tolist()
        assert [tuple(row) for row in found] == plain_runs(signs, least, times)


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (9, 3), (4, 5)])
def test_stretches_lose_no_run(least, times):
    texts = [[str(sign).encode() for sign in signs] for signs in sequences(3, 400, 70)]
    for words, table in zip(texts, runs_of_words(texts, least, times), strict=True):
        assert [tuple(row) for row in table.tolist()] == plain_runs(words, least, times)


def test_gram_length():
    assert gram_length(6, 4) == 5
    assert gram_length(2, 2) == 1


def test_hash_that_agrees_by_chance_is_cut_back(monkeypatch):
    from clickrev.llm import lyndon

    monkeypatch.setattr(
        lyndon.Extensions, "forward", lambda self, a, b: np.minimum(self._n - b, 20)
    )
    signs = np.array([0, 1] * 6 + [2, 3, 4, 5, 6, 7], np.int64)
    assert (0, 12, 2) in [tuple(row) for row in runs(signs, 6, 4).tolist()]


def plain_query(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 6, 4)
    gone = {k for start, length, q in found for k in range(start + q, start + length)}
    kept = " ".join(word for k, word in enumerate(words) if k not in gone)
    from fractions import Fraction

    best = min(found, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(listed), sha(kept),
    )


LOOP = "and so it goes " * 9
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a a a a a a"), (5, "a a a a a"), (None, LOOP), (6, LOOP), (6, LOOP),
    (7, "x y " * 8 + "z"), (8, "  b " * 7), (9, "p q " * 90 + "end " + "r s t " * 60),
    (10, "up up up up up up down " * 5), (11, "\x0b\x0c a\x1cb" * 6),
    *[(k, f"{k} " + "one two three four five " * 6 + "six") for k in range(20, 60)],
]


def test_query_against_brute_force(spark, tmp_path):
    rows = spark.createDataFrame([(i, t, i, "clash") for i, t in ROWS], "doc_id bigint, text string, start bigint, period string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    found = op11_lyndon_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=str) == sorted((plain_query(*row) for row in ROWS), key=str)


def test_query_on_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars < 1000").collect()
    found = {row.doc_id: tuple(row) for row in op11_lyndon_runs(spark, "/root/testdata/sf0.001").collect()}
    assert sum(row[1] > 0 for row in found.values()) > 5
    for row in rows:
        assert found[row.doc_id] == plain_query(row.doc_id, row.text)


def test_find_and_collapse(spark):
    rows = spark.createDataFrame([(i, "x", t) for i, t in ROWS], "doc_id int, start string, text string")
    found = {(r.doc_id, r.start, r.length, r.period) for r in find_runs(rows).filter("doc_id < 12").collect()}
    wanted = {(i, *run) for i, t in ROWS if i and i < 12 for run in plain_runs(words_of_text(t), 6, 4)}
    assert found == wanted
    texts = [(r.doc_id, r.text) for r in collapse_runs(rows).collect()]
    assert (6, "and so it goes") in texts and (3, " \n\t ") in texts and (1, None) in texts
    assert (4, "a") in texts and (5, "a a a a a") in texts


def test_long_text():
    words = words_of_text("p q " * 40_000 + "end " + "r s t " * 30_000 + " ".join(map(str, range(50_000))))
    (table,) = runs_of_words([words])
    assert table.tolist() == [[0, 80_000, 2], [80_001, 90_000, 3]]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert find_runs(empty).count() == 0 and collapse_runs(empty).count() == 0
    assert collapse_runs(empty).withColumn("n", F.lit(1)).columns == ["doc_id", "text", "n"]
