"""Parts of benchmark items, against plain edit distances."""
import random

import pytest

from clickrev.llm.decontaminate import WINDOW, Index, decontaminate, find_contamination, item_of, regions, window_starts
from test_operators import edits, letters, prose


def words(text, share):
    kept = text.split()
    return " ".join(kept[: round(share * len(kept))])


@pytest.mark.parametrize("length", [0, 1, WINDOW, WINDOW + 1, WINDOW + WINDOW // 2, 1000])
def test_windows_cover_the_item(length):
    starts = window_starts(length)
    if length <= WINDOW:
        assert starts == []
        return
    assert starts[0] == 0 and starts[-1] == length - WINDOW
    assert all(0 < b - a <= WINDOW // 2 for a, b in zip(starts, starts[1:]))


@pytest.mark.parametrize("share", [1.0, 0.95, 0.8, 0.5, 0.3])
def test_parts_of_a_long_item_are_found(share):
    item = prose(1, 200)
    index = Index([item_of(7, item)])
    part = words(item, share)
    text = prose(2, 60) + " " + part + " " + prose(3, 60)
    found = index.find(text)
    assert len(found) == 1 and found[0][0] == 7 and found[0][3] <= item_of(7, item).budget
    start, end, covered = found[0][1], found[0][2], found[0][4]
    # neither more nor much less than the part
    assert edits(letters(text[start:end]), letters(part)) <= 0.2 * len(letters(part))
    assert covered == 1.0 if share >= 0.95 else covered <= share + 0.03


def test_middles_and_ends_with_edits():
    item = prose(4, 200)
    code = letters(item)
    rng = random.Random(5)
    index = Index([item_of(1, item)])
    for _ in range(20):
        length = rng.randint(WINDOW * 3 // 2, len(code) // 2)
        start = rng.randint(0, len(code) - length)
        part = list(code[start : start + length])
        for place in range(40, length, 80):  # one edit in 80 letters
            part[place] = "x" if part[place] != "x" else "y"
        found = index.find(prose(rng.random(), 40) + " " + "".join(part))
        assert found and {row[0] for row in found} == {1}


def test_every_window_within_its_budget_is_found():
    """Whatever window of the item the text holds, by plain edit distance, a region covers."""
    item = prose(6, 80)
    code = letters(item)
    index = Index([item_of(1, item)])
    rng = random.Random(7)
    for _ in range(15):
        changed = list(code)
        for _ in range(rng.choice([5, 20, 40, 80])):
            place = rng.randrange(len(changed))
            changed[place : place + 1] = rng.choice([[], ["x"], [changed[place], "y"]])
        text = "".join(changed)
        budget = int(0.08 * WINDOW)
        expected = any(edits(code[start : start + WINDOW], text) <= budget for start in window_starts(len(code)))
        assert bool(index.find(text)) == (expected or edits(code, text) <= item_of(1, item).budget)


def test_two_places_and_a_whole_one():
    item = prose(8, 200)
    text = " ".join([words(item, 0.4), prose(9, 40), item, prose(10, 40), words(item, 0.5)])
    found = Index([item_of(3, item)]).find(text)
    assert sorted(share == 1.0 for *_, share in found) == [False, False, True]
    spans = sorted((start, end) for _, start, end, _, _ in found)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_short_parts_and_other_texts_stay():
    item = prose(11, 200)
    index = Index([item_of(1, item)])
    assert index.find(prose(12, 30) + " " + words(item, 0.08)) == []
    assert all(index.find(prose(seed, 400)) == [] for seed in range(100, 110))


def test_regions_of_no_window_and_of_repeats():
    assert list(regions([])) == []
    same = [(5, 165, 0, 1), (5, 165, 0, 2), (85, 245, 80, 0), (245, 405, 160, 3)]
    assert list(regions(same)) == [(5, 245, 2, 240), (245, 405, 3, WINDOW)]


def test_documents_with_half_an_item_go(spark):
    item = prose(13, 200)
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None)], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(1, prose(14, 50) + " " + words(item, 0.5)), (2, prose(15, 300)), (3, None), (None, words(item, 0.8))],
        "doc_id bigint, text string",
    )
    assert sorted(row.doc_id for row in decontaminate(docs, benchmark).collect()) == [2, 3]
    rows = find_contamination(docs, benchmark).collect()
    assert sorted((str(row.doc_id), row.item_id) for row in rows) == [("1", 1)] * 2 + [("None", 1)] * 2
    assert all(0.3 < row.share < 0.85 for row in rows)
