"""Toxicity of documents: misspelled lexicon terms, weighed by the words around them.

The lexicon is learned. Words, and beginnings of words that several words share, stand in it
if far more of the labelled texts that hold them are toxic than chance allows, counting
every candidate as a chance of its own (a bound on the binomial tail), and if toxic texts
use them in at least ``LEAST_CONTEXTS`` different neighbourhoods, so that copies of one text
teach nothing. A Levenshtein automaton intersected with the trie of the lexicon finds terms
with up to ``edits`` wrong letters.

A word that labelled texts use in other neighbourhoods is judged by these, so that a usual word
one letter away from a term is no misspelling of it. Every place found is weighed by a window of ``WINDOW`` words on both sides: inside quotation
marks or next to words of reporting it is likely a quotation, next to words that address
somebody likely abuse. How much a term, a distance and a kind of window weigh is the smoothed
share of toxic labelled texts with it. A document's score is that of its strongest place,
raised by further strong ones; without a place it is the share of toxic ones among labelled
texts without one.

Labels are learned from at most ``SAMPLE`` toxic and ``SAMPLE`` other labelled documents,
picked by a hash of their ids; every document is scored. Null and empty texts have no place.
Repeated labels of a document count once, toxic if any is; labels without a document or
with a null have no effect. Without labels every score is 0.
"""
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import map_arrow, slices, staged, texts_of
from clickrev.llm.language import held_out
from clickrev.llm.levenshtein import LexiconAutomaton

#: Labelled documents of each kind that the model is fitted on, at most.
SAMPLE = 20_000
WINDOW = 8
#: Words on both sides that make a neighbourhood.
BESIDE = 3
LEAST_CONTEXTS = 3
#: Share of toxic texts among those with a term; texts that quote it may be many.
LEAST_SHARE = 0.3
LEAST_STEM_SHARE = 0.8
#: No single word may make up more than this share of a stem's places.
LARGEST_WORD_SHARE = 0.8
CHANCE = 0.1
STEM_LETTERS = range(4, 10)
STEM_WORDS = 3
PREDICTED_AT = 0.5

# A sign like * or @ between letters belongs to the word.
_WORD = re.compile(r"\w+(?:[*@$]+\w+)*")
_LONGEST_WORD = 40  # letters that an entry of the lexicon may have
_CACHED_WORDS = 500_000

# Words of reporting, words of address, quotation marks.
_REPORTING = frozenset(
    "said says say wrote writes called calls word words term quote quoted quotes slur insult insults reported "
    "sagte sagt schrieb nannte wort wörter begriff zitat zitierte "
    "dit disait écrit appelé mot mots terme citation cité "
    "dijo dice escribió llamó palabra palabras término cita citó".split()
)
_ADDRESS = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton ta vous votre "
    "tú ti usted ustedes eres sois".split()
)
_OPENING, _CLOSING, _EITHER = "“„«‹‘", "”“»›’", '"'

QUOTED, REPORTED, ADDRESSED = 1, 2, 4
#: What a window of a kind does to the odds before labels say otherwise.
_PRIOR_ODDS = {QUOTED: 0.4, REPORTED: 0.5, ADDRESSED: 1.5}
_PRIOR_TEXTS = 8.0


def edits(term: str) -> int:
    """Wrong letters that a term of the lexicon may have.

    A second one would multiply the automaton's states by the length of the terms.
    """
    return int(len(term) >= 5)


def words_in(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def beside(words: list[str], k: int) -> int:
    """A digest of the neighbourhood of the k-th word."""
    return _digest(" ".join((*words[max(0, k - BESIDE) : k], "\0", *words[k + 1 : k + 1 + BESIDE])))


def window_kind(text: str, words: list[tuple[int, int]], k: int) -> int:
    """Bits of the window around the k-th word; ``words`` are the spans of all in ``text``."""
    first, last = max(0, k - WINDOW), min(len(words) - 1, k + WINDOW)
    before = text[words[first][0] : words[k][0]]
    after = text[words[k][1] : words[last][1] + 1]
    near = {text[a:b] for a, b in words[first : last + 1]}
    opened = max((before.rfind(mark) for mark in _OPENING), default=-1)
    closed = max(before.rfind(mark) for mark in _CLOSING if mark not in _OPENING)
    inside = opened > closed and any(mark in after for mark in _CLOSING)
    inside = inside or (before.count(_EITHER) % 2 == 1 and _EITHER in after)
    return (
        QUOTED * inside + REPORTED * (not near.isdisjoint(_REPORTING)) + ADDRESSED * (not near.isdisjoint(_ADDRESS))
    )


@dataclass
class Model:
    """The lexicon's automaton and the odds that go with what it finds."""

    automaton: LexiconAutomaton
    odds: dict[tuple[int, int], float] = field(default_factory=dict)  # of entry and distance
    word_odds: dict[str, float] = field(default_factory=dict)  # of words seen with labels
    distance_odds: dict[int, float] = field(default_factory=dict)
    window_factors: dict[int, float] = field(default_factory=dict)
    without: float = 0.0

    def __post_init__(self) -> None:
        self._known: dict[str, tuple[int, int] | None] = {}

    def places(self, text: str) -> list[tuple[int, int, int, str, int]]:
        """Entry, distance, kind of window, word and neighbourhood of each term in a text."""
        text = text.lower()
        words = _WORD.findall(text)
        found = self._look_up(words)
        if not found:
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        out = []
        for k, (entry, distance) in found:
            out.append((entry, distance, window_kind(text, spans, k), words[k], beside(words, k)))
        return out

    def _look_up(self, words: list[str]) -> list[tuple[int, tuple[int, int]]]:
        known = self._known
        if len(known) > _CACHED_WORDS:
            known.clear()
        new = [word for word in set(words) if word not in known]
        if new:
            entries, distances = self.automaton.match(new)
            known.update(dict.fromkeys(new))
            for k in np.flatnonzero(entries >= 0).tolist():
                known[new[k]] = (int(entries[k]), int(distances[k]))
        return [(k, hit) for k, word in enumerate(words) if (hit := known[word])]

    def score(self, text: str) -> tuple[float, int, int]:
        """Score, number of places, and how many of them look like quotations."""
        places = self.places(text)
        chances = []
        for entry, distance, kind, word, _ in places:
            odds = self.word_odds.get(word)
            if odds is None:
                odds = self.odds.get((entry, distance), self.distance_odds.get(distance, 0.0))
            odds *= self.window_factors.get(kind, 1.0)
            chances.append(odds / (1.0 + odds))
        strong = sorted((c for c in chances if c >= PREDICTED_AT), reverse=True)
        best = max([self.without, *chances])
        score = best + (1.0 - best) * 0.5 * (1.0 - 1.0 / max(1, len(strong)))
        quoted = sum(kind & (QUOTED | REPORTED) > 0 for _, _, kind, _, _ in places)
        return score, len(places), quoted


# --- Learning ------------------------------------------------------------------


def labelled_texts(docs: DataFrame, labels: DataFrame, at_most: int = SAMPLE) -> DataFrame:
    """``text, toxic``: a bounded sample of labelled documents, equal texts once."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = rows.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic, other = (
        known.filter(kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)
        for kind in (F.col("toxic") >= 1, F.col("toxic") < 1)
    )
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(toxic.unionByName(other)), "doc_id")  # twice the sample at most
        .groupBy("text")
        .agg((F.max("toxic") >= 1).cast("int").alias("toxic"))
    )


def _counted(texts: DataFrame) -> DataFrame:
    """``term, stem, toxic_n, other_n``: labelled texts with each word and beginning."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in slices(batches):
            for text, toxic in zip(texts_of(batch), batch.column("toxic").to_pylist(), strict=True):
                words = {w for w in words_in(text) if 3 <= len(w) <= _LONGEST_WORD}
                # a beginning has a sign of its own behind it
                words.update([f"{w[:n]}\0" for w in words for n in STEM_LETTERS if n < len(w)])
                counts[toxic].update(words)
        for toxic in (0, 1):
            terms = list(counts[toxic])
            for start in range(0, len(terms), 1 << 16):
                part = terms[start : start + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([t.rstrip("\0") for t in part], pa.string()),
                        pa.array([t[-1] == "\0" for t in part]),
                        pa.array([counts[1][t] if toxic else 0 for t in part], pa.int64()),
                        pa.array([0 if toxic else counts[0][t] for t in part], pa.int64()),
                    ],
                    ["term", "stem", "toxic_n", "other_n"],
                )

    schema = "term STRING, stem BOOLEAN, toxic_n BIGINT, other_n BIGINT"
    counted = map_arrow(texts, ["text", "toxic"], count, schema)
    return counted.groupBy("term", "stem").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("other_n").alias("other_n"))


def _telling(counted: DataFrame) -> DataFrame:
    """Terms whose share of toxic texts is high, and higher than chance gives any candidate."""
    totals = counted.agg(F.sum("toxic_n").alias("t"), F.sum("other_n").alias("o"), F.count(F.lit(1)).alias("n")).first()
    if not totals["t"]:
        return counted.limit(0)
    usual = totals["t"] / (totals["t"] + totals["o"])
    if usual >= 1:
        return counted.limit(0)
    n = F.col("toxic_n") + F.col("other_n")
    share = F.col("toxic_n") / n
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - usual))).otherwise(0.0)
    surprise = n * (share * F.log(share / usual) + rest)
    return counted.filter(
        (F.col("toxic_n") >= LEAST_CONTEXTS)
        & (share >= F.when(F.col("stem"), LEAST_STEM_SHARE).otherwise(LEAST_SHARE))
        & (share > usual)
        & (surprise >= math.log(totals["n"] / CHANCE))
    )


def _candidates_in_use(texts: DataFrame, terms: set[str], stems: set[str]) -> DataFrame:
    """``term, stem, contexts, words, most``: neighbourhoods and words toxic texts use it in.

    ``most`` is how many neighbourhoods the commonest of these words has.
    """
    shared = texts.sparkSession.sparkContext.broadcast((terms, stems))

    def contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, beginnings = shared.value
        for batch in slices(batches):
            rows = set()
            for text in texts_of(batch):
                words = words_in(text)
                for k, word in enumerate(words):
                    found = [(word, False)] if word in wanted else []
                    found += [(word[:n], True) for n in STEM_LETTERS if n < len(word) and word[:n] in beginnings]
                    if found:
                        place = beside(words, k)
                        rows.update((*term, word, place) for term in found)
            if rows:
                columns = zip(*sorted(rows), strict=True)
                types = (pa.string(), pa.bool_(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["term", "stem", "word", "place"]
                )

    toxic = texts.filter("toxic = 1")
    return (
        map_arrow(toxic, ["text"], contexts, "term STRING, stem BOOLEAN, word STRING, place BIGINT")
        .distinct()
        .groupBy("term", "stem", "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("term", "stem")
        .agg(F.sum("n").alias("contexts"), F.count(F.lit(1)).alias("words"), F.max("n").alias("most"))
    )


def learn_lexicon(texts: DataFrame) -> tuple[list[str], list[str]]:
    """Terms and stems. Their number is bounded by the sample, from which all words come."""
    counted = staged(texts.sparkSession, _counted(texts), "terms")
    rows = _telling(counted).select("term", "stem").collect()
    terms = {row["term"] for row in rows if not row["stem"]}
    stems = {row["term"] for row in rows if row["stem"]}
    shared_by_words = (F.col("words") >= STEM_WORDS) & (F.col("most") <= LARGEST_WORD_SHARE * F.col("contexts"))
    used = (
        _candidates_in_use(texts, terms, stems)
        .filter((F.col("contexts") >= LEAST_CONTEXTS) & (~F.col("stem") | shared_by_words))
        .select("term", "stem")
        .collect()
    )
    shortest: list[str] = []
    for stem in sorted(row["term"] for row in used if row["stem"]):
        if not any(stem.startswith(shorter) for shorter in shortest):
            shortest.append(stem)
    return sorted(row["term"] for row in used if not row["stem"]), shortest


def _share(toxic: float, other: float, prior: float, weight: float) -> float:
    return (toxic + weight * prior) / (toxic + other + weight)


def _odds(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return share / (1 - share)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labels of ``docs``; leave out what is to be held out beforehand."""
    spark = docs.sparkSession
    texts = staged(spark, labelled_texts(docs, labels), "toxicity")
    model = Model(LexiconAutomaton(*learn_lexicon(texts), edits))
    shared = spark.sparkContext.broadcast(model)

    def observe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in slices(batches):
            rows = set()
            for text, toxic in zip(texts_of(batch), batch.column("toxic").to_pylist(), strict=True):
                places = lexicon.places(text)
                for entry, distance, kind, word, place in places:
                    rows.add((word, entry, distance, kind, toxic, place))
                if not places:  # each text counts
                    rows.add(("", -1, 0, 0, toxic, _digest(text)))
            if rows:
                word, *numbers = zip(*sorted(rows), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word, pa.string()), *(pa.array(c, pa.int64()) for c in numbers)], ["word", *_OBSERVED]
                )

    counts = (
        map_arrow(texts, ["text", "toxic"], observe, ", ".join(["word STRING", *(f"{c} BIGINT" for c in _OBSERVED)]))
        .distinct()
        .groupBy("word", "entry", "distance", "kind", "toxic")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # words of the sample that match the lexicon
    )
    return _fitted(model, [tuple(row) for row in counts])


_OBSERVED = ["entry", "distance", "kind", "toxic", "place"]


def _fitted(model: Model, counts: list[tuple[str, int, int, int, int, int]]) -> Model:
    by: dict[tuple, list[float]] = {}
    of_word: dict[tuple[str, int, int], list[int]] = {}
    for word, entry, distance, kind, toxic, n in counts:
        for key in [("none",)] if entry < 0 else [("all",), ("k", kind)]:
            by.setdefault(key, [0.0, 0.0])[toxic] += n
        if entry >= 0:
            of_word.setdefault((word, entry, distance), [0, 0])[toxic] += n
    # what a word not seen before is worth: every word of the kind counts once
    for (_, entry, distance), (other, toxic) in of_word.items():
        for key in (("d", distance), ("e", entry, distance)):
            by.setdefault(key, [0.0, 0.0])[1] += toxic / (toxic + other)
            by[key][0] += other / (toxic + other)
    other, toxic = by.get(("none",), (0.0, 0.0))
    model.without = toxic / (toxic + other + 2.0)
    other, toxic = by.get(("all",), (0.0, 0.0))
    overall = _share(toxic, other, 0.5, 2.0)
    for key, (other, toxic) in by.items():
        if key[0] == "d":
            model.distance_odds[key[1]] = _odds(_share(toxic, other, 0.5, 2.0))
    for key, (other, toxic) in by.items():
        if key[0] == "e":
            prior = model.distance_odds[key[2]]
            model.odds[key[1:]] = _odds(_share(toxic, other, prior / (1 + prior), 4.0))
    for (word, entry, distance), (other, toxic) in of_word.items():
        prior = model.odds[entry, distance]
        model.word_odds[word] = _odds(_share(toxic, other, prior / (1 + prior), 1.0))
    for kind in range(8):
        prior = _odds(overall)
        for bit, factor in _PRIOR_ODDS.items():
            prior *= factor if kind & bit else 1.0
        other, toxic = by.get(("k", kind), (0.0, 0.0))
        model.window_factors[kind] = _odds(_share(toxic, other, prior / (1 + prior), _PRIOR_TEXTS)) / _odds(overall)
    return model


# --- Scoring -------------------------------------------------------------------

_SCORED = "doc_id BIGINT, score DOUBLE, n_places BIGINT, n_quoted BIGINT"


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted, n_places, n_quoted`` of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in slices(batches):
            scores, places, quoted = zip(*map(lexicon.score, texts_of(batch)), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(scores, pa.float64()),
                    pa.array(places, pa.int64()),
                    pa.array(quoted, pa.int64()),
                ],
                ["doc_id", "score", "n_places", "n_quoted"],
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    scored = map_arrow(rows, ["doc_id", "text"], score, _SCORED)
    predicted = (F.col("score") >= PREDICTED_AT).cast("int")
    return scored.select("doc_id", "score", predicted.alias("predicted"), "n_places", "n_quoted")


def op12_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = score_documents(docs, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_places", "n_quoted"
    )
