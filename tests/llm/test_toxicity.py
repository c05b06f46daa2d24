"""The automaton against edit distances, the model on planted terms, held-out labels, odd rows."""
import random

import pytest
from pyspark.sql import functions as F

from clickrev.llm.language import held_out
from clickrev.llm.levenshtein import LexiconAutomaton
from clickrev.llm.toxicity import (
    QUOTED,
    REPORTED,
    ADDRESSED,
    _WORD,
    edits,
    learn_lexicon,
    labelled_texts,
    op12_levenshtein_toxicity,
    score_documents,
    train,
    window_kind,
)

LETTERS = "abdeilmnorstu"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_automaton_against_edit_distances():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choices("abcé", k=rng.randint(3, 11))) for _ in range(40)})
    automaton = LexiconAutomaton(terms, ["zzab", "qq"], edits)
    words = ["", "zzab", "zzabc", "zza", "qqqq", "q", "日本"]
    for _ in range(4000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(word) + 1)
            word[k : k + rng.randint(0, 1)] = rng.choices("abcéx", k=rng.randint(0, 1))
        words.append("".join(word))
    entries, distances = automaton.match(words)
    for word, entry, found in zip(words, entries.tolist(), distances.tolist(), strict=True):
        near = min(((distance(t, word), k) for k, t in enumerate(terms) if distance(t, word) <= edits(t)), default=None)
        if near is None and word.startswith(("zzab", "qq")):
            near = (0, len(terms) + (not word.startswith("zzab")))
        assert (found, entry) == (near or (-1, -1)), word


def test_empty_lexicon_matches_nothing():
    assert LexiconAutomaton([], [], edits).match(["a", ""])[0].tolist() == [-1, -1]


@pytest.mark.parametrize(
    "text,kind",
    [
        ("you are a XX", ADDRESSED),
        ("he called him a XX there", REPORTED),
        ('they put "a plain XX" there', QUOTED),
        ("sie schrieb „du XX“ an die wand", QUOTED | REPORTED | ADDRESSED),
        ('a "closed" phrase and XX here', 0),
        ("a XX", 0),
    ],
)
def test_window_kind(text, kind):
    text = text.lower()
    spans = [m.span() for m in _WORD.finditer(text)]
    k = [text[a:b] for a, b in spans].index("xx")
    assert window_kind(text, spans, k) == kind


def prose(rng, words):
    return " ".join("".join(rng.choices(LETTERS, k=rng.randint(2, 8))) for _ in range(words))


def planted(count=2400):
    """Every tenth text holds an insult; some texts only quote one."""
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(count):
        words = prose(rng, 60).split()
        kind = k % 10
        term = rng.choice(["villainx", "wretchyy", "scoundrel"])
        if kind == 0:
            words.insert(rng.randrange(60), term)
        elif kind == 1:
            words.insert(rng.randrange(60), f'he said "{term}" there')
        rows.append((k, " ".join(words)))
        labels.append((k, int(kind == 0)))
    return rows, labels


@pytest.fixture(scope="module")
def model_of_planted(spark):
    rows, labels = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    return docs, marks, train(docs, marks.filter("doc_id % 3 <> 0"))


def test_lexicon_takes_only_telling_terms(spark):
    rows, labels = planted()
    rows = [(k, t) for k, t in rows if k % 10 != 1]
    copies = [(10_000 + k, prose(random.Random(9), 50)) for k in range(300)]  # one toxic text, copied
    docs = spark.createDataFrame(rows + copies, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels + [(k, 1) for k, _ in copies], "doc_id bigint, toxic int")
    terms, stems = learn_lexicon(labelled_texts(docs, marks))
    assert terms == ["scoundrel", "villainx", "wretchyy"] and stems == []


def test_stem_of_many_words(spark):
    rng = random.Random(4)
    rows, labels = planted()
    endings = [prose(rng, 1) + "q" for _ in range(40)]
    rows = [(k, t + (f" zorky{rng.choice(endings)} {prose(rng, 2)}" if k % 10 == 0 else "")) for k, t in rows]
    rows = [(k, t) for k, t in rows if k % 10 != 1]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    terms, stems = learn_lexicon(labelled_texts(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")))
    assert stems == ["zork"] and "scoundrel" in terms


def test_abuse_quotation_and_misspelling(model_of_planted, spark):
    model = model_of_planted[2]
    abuse, quoted = model.score("you are a scoundrel here")[0], model.score('he said "scoundrel" there')[0]
    assert abuse >= 0.5 > quoted
    assert model.score("what a scoundral he is")[1] == 1
    assert model.score("nothing here")[0] < 0.2
    assert model.score("scoundrel of a wretchyy")[0] > model.score("a scoundrel")[0] > 0.5


def test_held_out_planted(model_of_planted):
    docs, marks, model = model_of_planted
    rows = score_documents(docs.filter("doc_id % 3 = 0"), model).join(marks, "doc_id").collect()
    assert all(row.predicted == row.toxic for row in rows) and len(rows) == 800


def test_odd_rows(model_of_planted, spark):
    model = model_of_planted[2]
    rows = [(1, None), (2, ""), (3, "  \n"), (None, "scoundrel"), (4, "x " * 200_000 + "scoundrel"), (4, "a퟿ scoundrel's")]
    docs = spark.createDataFrame([(*r, "s", 0.5) for r in rows], "doc_id int, text string, predicted string, score double")
    found = sorted(score_documents(docs, model).collect(), key=str)
    assert len(found) == 6
    by_id = {(r.doc_id, r.n_places): r for r in found}
    for k in (1, 2, 3):
        assert by_id[k, 0].score == model.without and by_id[k, 0].predicted == 0
    assert by_id[None, 1].predicted == 1 and by_id[4, 1].predicted == 1
    assert score_documents(docs.limit(0), model).count() == 0


def test_without_labels_and_repeated_labels(spark):
    docs = spark.createDataFrame([(1, "a villainx"), (2, None), (None, "b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in score_documents(docs, train(docs, none)).collect()] == [0.0] * 3
    marks = spark.createDataFrame([(1, 0), (1, 1), (7, 1), (2, None), (None, 1)], "doc_id bigint, toxic int")
    assert [tuple(r) for r in labelled_texts(docs, marks).collect()] == [("a villainx", 1)]


def test_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    rows = op12_levenshtein_toxicity(spark, folder)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    found = rows.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic = [r.predicted for r in found if r.toxic]
    clean = [r.predicted for r in found if not r.toxic]
    assert sum(toxic) > 0.85 * len(toxic) and sum(clean) < 0.04 * len(clean)
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_rule(spark):
    ids = spark.range(5).select(held_out(F.col("id")).alias("h")).collect()
    import zlib

    assert [r.h for r in ids] == [zlib.crc32(str(k).encode()) % 5 == 0 for k in range(5)]
