"""Language identification by unigram pieces, all segmentations summed.

The vocabulary is that of a public tokenizer: its pieces of letters, in lower case. Each
language has a probability for every piece. A word's probability in a language is the sum,
over all ways to cut it into pieces, of the product of the pieces' probabilities, which the
forward algorithm gives without listing them; a text's is the product over its words.

Training is one expectation step: forward and backward sums under equal piece
probabilities give, for every word, how often each piece is used in expectation; tasks add
these counts up per language, and the counts, smoothed, are the probabilities. The model has
languages x pieces numbers, however much text there is.

Words are runs of letters in lower case. A letter outside the vocabulary counts as a piece
of the smallest probability. A text that is null or has no letter is ``und`` with score 0.
Otherwise the score is the posterior probability of the language under equal priors; ties
go to the language first in the alphabet. Without training rows every text is ``und``.
Repeated rows are scored one by one; other columns are not read.
"""
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import slices, texts_of
from clickrev.llm.words import MIX_A, mixed

VOCABULARY_FILE = "piece_bpe_32k.model"
UNDETERMINED = "und"
HELD_OUT_MODULUS = 5

_WORD = re.compile(r"[^\W\d_]+")
_SMOOTHING = 0.5
_UNKNOWN = 1e-9
# Words up to this length share a table per length, whose smallest products still are above the
# smallest double; each longer one is summed up by itself, in logarithms.
_TABLE_LETTERS = 30
_CACHED_WORDS = 600_000
_TABLE_BITS = 22


class Pieces:
    """The vocabulary, and look-up of many substrings at once by their hashes."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        raw = (model.id_to_piece(i).replace("▁", "").lower() for i in range(len(model)))
        self.pieces = sorted({piece for piece in raw if _WORD.fullmatch(piece)})
        self.longest = max(map(len, self.pieces))
        keys = np.array([self._hash(piece) for piece in self.pieces], np.uint64)
        self._order = np.argsort(keys)
        self._keys = keys[self._order]
        # for each value of their leading bits, the first of the sorted keys and how many
        leading = np.arange(1 << _TABLE_BITS, dtype=np.uint64) << np.uint64(64 - _TABLE_BITS)
        self._first = np.searchsorted(self._keys, leading).astype(np.int32)
        self._many = np.diff(self._first, append=len(keys)).astype(np.int8)

    @staticmethod
    def _hash(piece: str) -> np.uint64:
        value = np.zeros(1, np.uint64)
        for letter in piece:
            value = value * MIX_A + np.uint64(ord(letter) + 1)
        return mixed(value)[0]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that belong to a piece, and the indexes of these pieces."""
        slots = (hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int32)
        many = self._many[slots]
        rows, pieces = [], []
        for step in range(int(many.max(initial=0))):
            row = np.flatnonzero(many > step)
            at = self._first[slots[row]] + step
            hit = self._keys[at] == hashes[row]
            rows.append(row[hit])
            pieces.append(self._order[at[hit]])
        if not rows:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(rows), np.concatenate(pieces)

    def lattice(self, words: list[str]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """For words of one length: by start and end, which words have a piece there, and which."""
        length = len(words[0])
        codes = np.array([[ord(letter) + 1 for letter in word] for word in words], np.uint64)
        edges = {}
        for start in range(length):
            value = np.zeros(len(words), np.uint64)
            for end in range(start + 1, min(length, start + self.longest) + 1):
                value = value * MIX_A + codes[:, end - 1]
                edges[start, end] = self.find(mixed(value))
        return edges

    def paths(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and pieces (-1: a letter that is none) of one word, by end."""
        codes = np.array([ord(letter) + 1 for letter in word], np.uint64)
        starts, ends, pieces = [], [], []
        value = np.zeros(len(word), np.uint64)
        for width in range(1, min(len(word), self.longest) + 1):
            value = value[: len(word) - width + 1] * MIX_A + codes[width - 1 :]
            row, piece = self.find(mixed(value))
            if width == 1:
                unknown = np.setdiff1d(np.arange(len(word)), row)
                row = np.concatenate([row, unknown])
                piece = np.concatenate([piece, np.full(len(unknown), -1)])
            starts.append(row)
            ends.append(row + width)
            pieces.append(piece)
        start, end, piece = map(np.concatenate, (starts, ends, pieces))
        order = np.argsort(end, kind="stable")
        return start[order], end[order], piece[order]


def log_sums(starts: np.ndarray, ends: np.ndarray, logs: np.ndarray, length: int) -> np.ndarray:
    """Forward sums in logarithms, for edges in the order of their ends; a row per position."""
    table = np.zeros((length + 1, logs.shape[1]))
    cuts = np.searchsorted(ends, np.arange(1, length + 2))
    for end in range(1, length + 1):
        edges = slice(cuts[end - 1], cuts[end])
        table[end] = np.logaddexp.reduce(table[starts[edges]] + logs[edges], axis=0)
    return table


_pieces: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """One vocabulary per worker process."""
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def _by_length(words: Iterable[str]) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    for group in groups.values():
        for start in range(0, len(group), 20_000):
            yield group[start : start + 20_000]


def expected_counts(pieces: Pieces, words: Counter) -> np.ndarray:
    """Expected uses of each piece over weighted words, all pieces being equally likely."""
    share = 1.0 / len(pieces.pieces)
    totals = np.zeros(len(pieces.pieces))
    for word, weight in words.items():
        if len(word) > _TABLE_LETTERS:
            _add_long_word(pieces, word, weight, totals)
    for group in _by_length(word for word in words if len(word) <= _TABLE_LETTERS):
        length, n = len(group[0]), len(group)
        weights = np.array([words[word] for word in group], float)
        edges = pieces.lattice(group)
        unknown = _unknown_letters(edges, length, n)
        forward, backward = np.zeros((length + 1, n)), np.zeros((length + 1, n))
        forward[0] = backward[length] = 1.0
        for start, end in sorted(edges, key=lambda edge: (edge[1], edge[0])):
            row, _ = edges[start, end]
            forward[end, row] += forward[start, row] * share
            if end == start + 1:
                forward[end, unknown[start]] += forward[start, unknown[start]] * _UNKNOWN
        for start, end in sorted(edges, reverse=True):
            row, _ = edges[start, end]
            backward[start, row] += backward[end, row] * share
            if end == start + 1:
                backward[start, unknown[start]] += backward[end, unknown[start]] * _UNKNOWN
        weights *= share / forward[length]
        for (start, end), (row, index) in edges.items():
            use = weights[row] * forward[start, row] * backward[end, row]
            totals += np.bincount(index, use, len(totals))
    return totals


def _add_long_word(pieces: Pieces, word: str, weight: int, totals: np.ndarray) -> None:
    start, end, piece = pieces.paths(word)
    length = len(word)
    logs = np.where(piece < 0, np.log(_UNKNOWN), -np.log(len(totals)))[:, None]
    forward = log_sums(start, end, logs, length)[:, 0]
    order = np.argsort(length - start, kind="stable")
    backward = log_sums((length - end)[order], (length - start)[order], logs[order], length)[::-1, 0]
    use = weight * np.exp(forward[start] + logs[:, 0] + backward[end] - forward[length])
    totals += np.bincount(piece[piece >= 0], use[piece >= 0], len(totals))


def _unknown_letters(edges: dict, length: int, n: int) -> list[np.ndarray]:
    """By position, the words whose letter there is no piece."""
    unknown = []
    for start in range(length):
        missing = np.ones(n, bool)
        missing[edges[start, start + 1][0]] = False
        unknown.append(np.flatnonzero(missing))
    return unknown


@dataclass(frozen=True)
class LanguageModel:
    """``probabilities`` has a row per language and a column per piece."""

    vocabulary: str
    languages: tuple[str, ...]
    probabilities: np.ndarray


def train(docs: DataFrame, vocabulary: str | None = None) -> LanguageModel:
    """Learn from ``docs`` (text, lang); rows without a language are left out.

    Tasks send counts per language and piece, which Spark sums up.
    """
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY_FILE)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(vocabulary)
        totals: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def settle() -> None:
            for lang, counted in words.items():
                totals[lang] = totals.get(lang, 0) + expected_counts(pieces, counted)
            words.clear()

        for batch in slices(batches):
            for text, lang in zip(texts_of(batch), batch.column("lang").to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(_WORD.findall(text.lower()))
            if sum(map(len, words.values())) > _CACHED_WORDS:
                settle()
        settle()
        for lang, counts in totals.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(used), pa.string()),
                    pa.array(used, pa.int32()),
                    pa.array(counts[used], pa.float64()),
                ],
                ["lang", "piece", "uses"],
            )

    labelled = docs.filter(F.col("lang").isNotNull()).select("text", "lang")
    counts = labelled.mapInArrow(count, "lang STRING, piece INT, uses DOUBLE")
    rows = counts.groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))
    table = rows.toPandas()  # languages x pieces at most
    languages = tuple(sorted(table["lang"].unique()))
    size = len(pieces_of(vocabulary).pieces)
    probabilities = np.full((len(languages), size), _SMOOTHING)
    for k, lang in enumerate(languages):
        own = table[table["lang"] == lang]
        probabilities[k, own["piece"]] += own["uses"]
    # sums of doubles depend on the order of tasks; six digits do not
    probabilities = np.array(np.round(probabilities, 3))
    probabilities /= probabilities.sum(axis=1, keepdims=True) if len(languages) else 1.0
    return LanguageModel(vocabulary, languages, probabilities)


class WordScores:
    """Log-probabilities of words in every language, remembered for the texts to come."""

    def __init__(self, model: LanguageModel) -> None:
        self._pieces = pieces_of(model.vocabulary)
        self._table = np.maximum(model.probabilities.T, _UNKNOWN)
        self._place: dict[str, int] = {}
        self._logs = np.empty((0, len(model.languages)))

    def of(self, texts: list[str]) -> list[np.ndarray | None]:
        """Per text the log-probability in each language; None without a letter."""
        split = [_WORD.findall(text.lower()) for text in texts]
        if len(self._place) > _CACHED_WORDS:
            self._place, self._logs = {}, self._logs[:0]
        self._learn({word for words in split for word in words if word not in self._place})
        out: list[np.ndarray | None] = []
        for words in split:
            places = np.fromiter(map(self._place.__getitem__, words), np.int64, len(words))
            out.append(self._logs[places].sum(axis=0) if words else None)
        return out

    def _learn(self, words: set[str]) -> None:
        rows = [self._logs]
        long = sorted(word for word in words if len(word) > _TABLE_LETTERS)
        groups = [*_by_length(sorted(words.difference(long))), *([word] for word in long)]
        for group in groups:
            rows.append(self._score(group) if len(group[0]) <= _TABLE_LETTERS else self._score_long(group[0]))
            for word in group:
                self._place[word] = len(self._place)
        self._logs = np.concatenate(rows)

    def _score_long(self, word: str) -> np.ndarray:
        start, end, piece = self._pieces.paths(word)
        logs = np.where(piece[:, None] < 0, np.log(_UNKNOWN), np.log(self._table[piece]))
        return log_sums(start, end, logs, len(word))[-1:]

    def _score(self, words: list[str]) -> np.ndarray:
        """The forward algorithm over words of one length, ``_TABLE_LETTERS`` at most."""
        edges = self._pieces.lattice(words)
        length, n = len(words[0]), len(words)
        unknown = _unknown_letters(edges, length, n)
        forward = np.zeros((length + 1, n, self._table.shape[1]))
        forward[0] = 1.0
        for start, end in sorted(edges, key=lambda edge: (edge[1], edge[0])):
            row, index = edges[start, end]
            forward[end, row] += forward[start, row] * self._table[index]
            if end == start + 1:
                forward[end, unknown[start]] += forward[start, unknown[start]] * _UNKNOWN
        return np.log(forward[length])


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """Add the language and its score to ``docs``, in two new columns ``into``. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x pieces numbers
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema], f"`{into[0]}` STRING, `{into[1]}` DOUBLE"])

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = shared.value.languages
        scores = WordScores(shared.value)
        for batch in slices(batches):
            found: list[str] = []
            certain: list[float] = []
            for logs in scores.of(texts_of(batch, text)):
                if logs is None or not languages:
                    found.append(UNDETERMINED)
                    certain.append(0.0)
                else:
                    best = int(np.argmax(logs))
                    found.append(languages[best])
                    certain.append(float(1.0 / np.exp(logs - logs[best]).sum()))
            arrays = [*batch.columns, pa.array(found, pa.string()), pa.array(certain, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *into])

    return docs.mapInArrow(predict, schema)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents nothing is learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_MODULUS == 0, F.lit(True))


def op3_segmented_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
