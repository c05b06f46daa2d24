"""Periodic runs of words in whole texts, and their removal.

A run is a stretch of consecutive words with smallest period q (words q apart are the same),
of at least ``LEAST`` words and ``TIMES`` periods, that no neighbouring word extends. Runs
come from Lyndon roots of both orders (``lyndon.py``).

Before that, stretches that can hold no run are left out, without a loss: every k-gram of
words inside a run comes again inside it, q words further on or back, where k is the
largest length for which that holds at every period (5 for six words and four periods). So
a run lies within one stretch of consecutive k-grams that come again within a distance of
the stretch's length over ``TIMES``; a neighbouring word that would extend it would belong
to the stretch as well. k-grams are compared by hashes, which can only add stretches.

Words are what ASCII white space separates. Null and empty text has no word and no run.
Repeated rows and null ids each give rows of their own. A task holds one group of texts of
about ``GROUP_WORDS`` words, or one longer text; nothing is shuffled.
"""
import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clickrev.llm.arrow import map_arrow, slices, texts_of
from clickrev.llm.lyndon import runs
from clickrev.llm.words import MIX_A, mixed, rolling

LEAST = 6
TIMES = 4
GROUP_WORDS = 200_000


def words_of_text(text: str | None) -> list[bytes]:
    """Words in UTF-8; ``bytes.split`` cuts at just the blank and 0x09 to 0x0D."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def gram_length(least: int, times: int) -> int:
    """The longest k with 2 q + k - 1 words in every run, whatever its period q."""
    return max(1, min(max(least, times * q) - 2 * q + 1 for q in range(1, least + 1)))


def stretches(ids: np.ndarray, text_of: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (in words) of the stretches that may hold a run."""
    k = gram_length(least, times)
    hashes = rolling(mixed(ids.astype(np.uint64) + np.uint64(1)), k)
    starts = np.flatnonzero(text_of[: len(hashes)] == text_of[k - 1 :])
    hashes = hashes[starts]
    part = text_of[starts].astype(np.uint64)
    while True:
        keys = hashes + part * MIX_A
        order = np.argsort(keys, kind="stable")
        alike = keys[order][1:] == keys[order][:-1]
        gaps = (starts[order][1:] - starts[order][:-1])[alike]
        nearest = np.full(len(starts), np.iinfo(np.int64).max)
        nearest[order[1:][alike]] = gaps
        np.minimum.at(nearest, order[:-1][alike], gaps)
        held = nearest < np.iinfo(np.int64).max
        held_starts, held_texts = starts[held], text_of[starts[held]]
        opens = np.ones(len(held_starts), bool)
        opens[1:] = (np.diff(held_starts) != 1) | (np.diff(held_texts) != 0)
        stretch = np.cumsum(opens) - 1
        width = np.bincount(stretch, minlength=1) + k - 1
        fits = (width[stretch] >= least) & (nearest[held] <= width[stretch] // times)
        if held.all() and fits.all():
            break
        starts, hashes = held_starts[fits], hashes[held][fits]
        part = stretch[fits].astype(np.uint64)
    first = held_starts[opens]
    return first, first + (width if len(first) else 0)


def runs_of_words(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """``start, length, period`` of the runs of each list of words."""
    known: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(words) for words in texts], np.int64)
    ids = np.fromiter((known[word] for words in texts for word in words), np.int64, int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    text_of = np.repeat(np.arange(len(texts)), sizes)
    none = np.empty((0, 3), np.int64)
    out = [none] * len(texts)
    if len(ids) < max(least, 2):
        return out
    first, end = stretches(ids, text_of, least, times)
    if not len(first):
        return out
    # all stretches one after another, an id of -1 after each
    lengths = end - first
    places = np.repeat(first - np.cumsum(lengths + 1) + lengths + 1, lengths + 1) + np.arange(int(lengths.sum()) + len(first))
    closing = np.cumsum(lengths + 1) - 1
    sequence = ids[np.minimum(places, len(ids) - 1)]
    _, sequence = np.unique(sequence, return_inverse=True)
    sequence[closing] = -1
    table = runs(sequence, least, times)
    if not len(table):
        return out
    table[:, 0] = places[table[:, 0]]
    owner = text_of[table[:, 0]]
    table[:, 0] -= begins[owner]
    order = np.lexsort((table[:, 2], table[:, 0], owner))
    table, owner = table[order], owner[order]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for rows, text in zip(np.split(table, cuts), owner[np.concatenate([[0], cuts])].tolist(), strict=True):
        out[text] = rows
    return out


def without_repeats(words: list[bytes], table: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(table):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, table[:, 0] + table[:, 2], 1)
    np.add.at(depth, table[:, 0] + table[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def _groups(items: Iterable[list[bytes]]) -> Iterator[list[list[bytes]]]:
    group: list[list[bytes]] = []
    size = 0
    for words in items:
        group.append(words)
        size += len(words)
        if size > GROUP_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


Edit = Callable[[int | None, list[bytes]], list[bytes]]


def _with_runs(batch: pa.RecordBatch, least: int, times: int, edit: Edit | None = None) -> Iterator[tuple]:
    """doc_id, words and runs of each row."""
    ids = batch.column("doc_id").to_pylist()
    words = map(words_of_text, texts_of(batch))
    if edit:
        words = map(edit, ids, words)
    place = 0
    for group in _groups(words):
        for row in zip(group, runs_of_words(group, least, times), strict=True):
            yield ids[place], *row
            place += 1


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id, start, length, period`` (in words) of every run in ``docs`` (doc_id, text)."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for doc_id, _, table in _with_runs(batch, least, times):
                if len(table):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id] * len(table), pa.int64()), *(pa.array(table[:, k]) for k in range(3))],
                        ["doc_id", "start", "length", "period"],
                    )

    columns = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return map_arrow(columns, ["doc_id", "text"], find, "doc_id BIGINT, start BIGINT, length BIGINT, period BIGINT")


def collapse_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with every text's runs cut down to their first period.

    A text with a run becomes its other words, one blank between two; others stay as they are.
    """
    names = docs.columns
    at = names.index("text")

    def collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            place = 0
            for group in _groups(map(words_of_text, texts)):
                for words, table in zip(group, runs_of_words(group, least, times), strict=True):
                    if len(table):
                        joined = b" ".join(without_repeats(words, table))
                        texts[place] = joined.decode("utf-8", "surrogatepass")
                    place += 1
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(collapse, docs.schema)


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document, by a hash of its id, with a tail made periodic.

    A document without an id stays as it is.
    """
    n = len(words)
    if doc_id is None or n == 0:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * -(-(n - a) // p))[: n - a]


_DIGEST = (
    "doc_id BIGINT, n_runs BIGINT, start BIGINT, length BIGINT, period BIGINT, exponent_milli BIGINT, "
    "runs_sha256 STRING, collapsed_sha256 STRING"
)
_DIGEST_TYPES = [*[pa.int64()] * 6, pa.string(), pa.string()]


def strongest(table: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length over period; then the smallest start, then period."""
    best = None
    for start, length, period in table.tolist():  # in the order of start, then period
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def op11_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, some with a repeated tail, and digests of runs and kept words."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, words, table in _with_runs(batch, LEAST, TIMES, repeated_tail):
                best = strongest(table)
                listed = "".join(f"{s},{m},{q}\n" for s, m, q in table.tolist())
                kept = b" ".join(without_repeats(words, table))
                rows.append(
                    (
                        doc_id,
                        len(table),
                        *(best or (None, None, None)),
                        best and 1000 * best[1] // best[2],
                        hashlib.sha256(listed.encode()).hexdigest(),
                        hashlib.sha256(kept).hexdigest(),
                    )
                )
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), _DIGEST_TYPES, strict=True)],
                    [field.split()[0] for field in _DIGEST.split(", ")],
                )

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return map_arrow(docs, ["doc_id", "text"], digest, _DIGEST)
