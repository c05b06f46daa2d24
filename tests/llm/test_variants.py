"""Spelling variants against brute force over all pairs of words, and odd rows."""
import random
import re
import zlib
from collections import Counter

from clickrev.llm.variants import (
    near_pairs,
    op13_partenum_variants,
    roots_of,
    signatures,
    variant_forms,
    with_slips,
    word_counts,
)


def one_edit(word, letters):
    """All strings exactly one edit away."""
    near = set()
    for k in range(len(word) + 1):
        near.update(word[:k] + c + word[k:] for c in letters)
        if k < len(word):
            near.add(word[:k] + word[k + 1 :])
            near.update(word[:k] + c + word[k + 1 :] for c in letters)
    return near - {word}


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{word}".encode())
            if h % 31 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    return {word: n for word, n in counts.items() if n >= 2}


def plain_forms(counts, ratio=10):
    letters = sorted(set("".join(counts)))
    near = {word: sorted(one_edit(word, letters) & counts.keys()) for word in counts}
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * n else None
    out = set()
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        f = form[word]
        out.add((word, f, root, n, len(near[word]), None if f is None else counts[f]))
    return out


def test_one_edit_shares_a_signature():
    rng = random.Random(4)
    for _ in range(3000):
        word = "".join(rng.choices("abcdeéß", k=rng.randint(7, 14)))
        other = rng.choice(sorted(one_edit(word, "abcdeéßx")))
        if len(other) >= 7:
            a, b = signatures([word, other])
            assert (a == b).any()


def test_pairs_against_brute_force(spark):
    rng = random.Random(5)
    words = {"".join(rng.choices("abé", k=rng.randint(6, 9))) for _ in range(2500)}
    rows = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    found = [(r.a, r.b) for r in near_pairs(rows).collect()]
    wanted = {(a, b) for a in words if len(a) >= 7 for b in one_edit(a, "abé") & words if len(b) >= 7 and a < b}
    assert len(found) == len(set(found)) and set(found) == wanted and wanted


def test_hot_group_of_words(spark):
    """All words of the same letters, so all their signatures without the ends are alike."""
    rng = random.Random(6)
    words = {"".join(rng.sample("aabbccdde", 9)) for _ in range(3000)} | {"aabbccdd", "aabbccdde"}
    rows = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    found = {(r.a, r.b) for r in near_pairs(rows).collect()}
    assert found == {(a, b) for a in words for b in one_edit(a, "abcde") & words if a < b}


CHAIN = "Wonderful " * 2000 + "wonderfull " * 150 + "wonderfulll " * 12 + "Wondërful wondërful "
ROWS = [
    (1, None), (2, ""), (3, "  \n 12 !"), (None, CHAIN), (None, "Straße STRASSE Straßen straßen ÀÉÎõü×÷ " * 3),
    (4, CHAIN), (4, CHAIN), (5, "wonderfulı wonderfulłx 中wonderful_wonderful9wonderful" * 3),
    *[(k, "abcdefgh abcdefgi xbcdefgh abcdefg ABCDEFGH") for k in range(10, 200)],
]


def test_query_against_brute_force(spark, tmp_path):
    columns = "doc_id bigint, text string, word string, n string, form int"
    spark.createDataFrame([(*row, "w", "n", 1) for row in ROWS], columns).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(row) for row in op13_partenum_variants(spark, str(tmp_path)).collect()]
    wanted = plain_forms(plain_words(ROWS))
    assert len(found) == len(wanted) and set(found) == wanted
    roots = {row[0]: row[2] for row in found}
    assert roots["wonderfulll"] == "wonderful"


def test_query_on_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(row) for row in op13_partenum_variants(spark, folder).collect()]
    wanted = plain_forms(plain_words([tuple(row) for row in docs]))
    assert len(found) == len(wanted) and set(found) == wanted
    assert any(row[4] for row in found)


def test_given_words(spark):
    rows = [("aaaaaaa", 5), ("aaaaaaa", 95), ("aaaaaaab", 10), ("aaaaaabb", 1), (None, 7), ("short", 3)]
    found = {tuple(r) for r in variant_forms(spark.createDataFrame(rows, "word string, n bigint")).collect()}
    assert found == {
        ("aaaaaaa", None, "aaaaaaa", 100, 1, None),
        ("aaaaaaab", "aaaaaaa", "aaaaaaa", 10, 2, 100),
        ("aaaaaabb", "aaaaaaab", "aaaaaaa", 1, 1, 10),
        (None, None, None, 7, 0, None),
        ("short", None, "short", 3, 0, None),
    }


def test_ties_take_the_smallest_word(spark):
    rows = [("bbbbbbbx", 20), ("bbbbbbbé", 20), ("bbbbbbba", 20), ("bbbbbbb", 2)]
    found = {r.word: r.form for r in variant_forms(spark.createDataFrame(rows, "word string, n bigint")).collect()}
    assert found["bbbbbbb"] == "bbbbbbba" and found["bbbbbbbx"] is None


def test_long_chain_of_forms(spark):
    rows = [(str(k), str(k + 1)) for k in range(40)]
    found = {r.word: r.root for r in roots_of(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert set(found.values()) == {"40"} and len(found) == 40


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert word_counts(empty).count() == 0
    assert variant_forms(word_counts(empty, edit=with_slips)).count() == 0
