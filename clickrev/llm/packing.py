"""Lexical retrieval packing: windows of tokens filled with related documents.

Documents are dealt into shards of bounded size by content: each has a few min-hash keys,
telling token ids drawn with a chance in proportion to their number in the tokenizer, which
counts from common to rare pieces, so documents that share rare ids share keys. A range shuffle puts the documents in the order of
their keys, wherever they lie in the input; rows alike in all keys go by id, then text, then
place, so a hot key or many copies are spread over several ranges. Each task cuts its range into
shards and builds a BM25 inverted index over the token ids of a shard. Document frequencies
and the mean length are those of the whole corpus, counted while texts are encoded. A document's neighbours are
those of its shard: copies share all keys and so nearly always a shard, while looser
relatives may be dealt to another. The first unused document is a seed: it fills windows, and
the room left in its last one goes to its nearest unused neighbours by BM25, best first,
ties by their order. The neighbour that does not fit is cut, its rest opens the next window
and it is the seed there. Without a neighbour of positive score the next unused document
goes on. So windows are full but for the last of each shard.

The token ids are stored once in the shared folder, so texts are encoded once. A document
longer than a shard ends the shard it is added to. A task that runs again, after its
executor was lost, packs the same rows the same way.

Null or empty text has the end id only. Repeated rows are packed one by one, and a null
doc_id is kept. Other columns are not read.
"""
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import map_arrow, slices, staged, texts_of
from clickrev.llm.tokens import END_ID, TOKENIZER_FILE, encoder_for

WINDOW = 1024
SHARD_TOKENS = 1 << 19
#: Shards in one range of the shuffle.
RANGE_SHARDS = 4
KEYS = 3
#: Rows encoded at a time; a word is looked up once for all of them.
ENCODED_AT_ONCE = 4096
_K1, _B = 1.2, 0.75

_PIECES = [
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
]
_SCHEMA = ", ".join(f"`{name}` BIGINT" for name, _ in _PIECES)


@dataclass(frozen=True)
class Corpus:
    """What BM25 needs to know of all documents."""

    documents: int
    tokens: int
    frequency: np.ndarray  # documents with each token id

    def idf(self) -> np.ndarray:
        # a term in half of the documents or more tells nothing
        n, frequency = self.documents, self.frequency
        return np.maximum(0.0, np.log((n - frequency + 0.5) / (frequency + 0.5)))


def corpus_of(documents: list[np.ndarray]) -> Corpus:
    terms = np.concatenate([np.unique(ids) for ids in documents])
    return Corpus(len(documents), sum(map(len, documents)), np.bincount(terms))


def key_ranks(size: int) -> np.ndarray:
    """Per key and token id a number; a document's key is its id of the smallest.

    An exponential draw over a weight, the same for all documents. The weight is the id
    itself: the tokenizer numbers its pieces from common to rare ones, so it says how telling
    an id is before anything is counted. The end id has no finite rank.
    """
    draws = np.random.default_rng(0).exponential(size=(KEYS, size))
    weights = np.broadcast_to(np.arange(size, dtype=float), draws.shape)
    return np.divide(draws, weights, out=np.full_like(draws, np.inf), where=weights > 0)


def content_keys(terms: np.ndarray, ranks: np.ndarray) -> list[int]:
    """The min-hash keys of a document's token ids, -1 without a telling one."""
    found = ranks[:, terms]
    best = found.argmin(axis=1)
    return [int(terms[b]) if np.isfinite(found[k, b]) else -1 for k, b in enumerate(best)]


def _counted(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers in order, and how often each is there."""
    counts = np.bincount(numbers)
    different = np.flatnonzero(counts)
    return different, counts[different]


class Bm25:
    """Inverted index over the token ids of a shard's documents."""

    def __init__(self, documents: list[np.ndarray], corpus: Corpus | None = None) -> None:
        corpus = corpus or corpus_of(documents)
        n = len(documents)
        different = np.flatnonzero(np.bincount(np.concatenate(documents)))
        # the shard's terms by their number among them, so a document is counted in a short array
        numbers = np.zeros(different[-1] + 1, np.min_scalar_type(len(different)))
        numbers[different] = np.arange(len(different))
        counted = [_counted(numbers[ids]) for ids in documents]
        self._terms = [terms for terms, _ in counted]
        counts = np.concatenate([counts for _, counts in counted]).astype(float)
        terms = np.concatenate(self._terms)
        owner = np.repeat(np.arange(n), [len(t) for t in self._terms])
        lengths = np.array([len(ids) for ids in documents], float)
        frequency = np.bincount(terms)
        idf = corpus.idf()[different]
        norm = _K1 * (1 - _B + _B * lengths / max(corpus.tokens / corpus.documents, 1.0))
        weights = idf[terms] * counts * (_K1 + 1) / (counts + norm[owner])
        telling = weights > 0
        order = np.argsort(terms[telling].astype(numbers.dtype), kind="stable")
        self._owner, self._weights = owner[telling][order], weights[telling][order]
        many = np.where(idf > 0, frequency, 0)
        self._ends = np.cumsum(many)
        self._starts = self._ends - many
        self._size = n

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the terms of one."""
        first, last = self._starts[self._terms[seed]], self._ends[self._terms[seed]]
        many = last - first
        at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        return np.bincount(self._owner[at], self._weights[at], self._size)


def pack(
    documents: list[np.ndarray], window: int = WINDOW, corpus: Corpus | None = None
) -> Iterator[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of every piece of a shard."""
    index = Bm25(documents, corpus)
    used = np.zeros(len(documents), bool)
    next_unused = 0
    neighbours: Iterator[int] = iter(())
    sequence, offset = 0, 0
    for _ in range(len(documents)):
        document = next((k for k in neighbours if not used[k]), None)
        if document is None:
            while used[next_unused]:
                next_unused += 1
            document = next_unused
        used[document] = True
        start, length = 0, len(documents[document])
        cut = offset == 0
        while start < length:
            size = min(window - offset, length - start)
            yield document, start, size, sequence, offset
            start, offset = start + size, offset + size
            if offset == window:
                sequence, offset, cut = sequence + 1, 0, True
        if cut and offset:  # it opened the window that is being filled
            neighbours = _best_first(index.scores(document), used)
        elif not offset:
            neighbours = iter(())


def _best_first(scores: np.ndarray, used: np.ndarray) -> Iterator[int]:
    found = np.flatnonzero((scores > 0) & ~used)
    return iter(found[np.argsort(-scores[found], kind="stable")].tolist())


_KEY_NAMES = [f"key{k}" for k in range(KEYS)]
_STORED = [
    ("doc_id", pa.int64(), "BIGINT"),
    ("width", pa.int32(), "INT"),
    ("ids", pa.binary(), "BINARY"),
    ("hash", pa.int64(), "BIGINT"),
    *[(name, pa.int64(), "BIGINT") for name in _KEY_NAMES],
]


def _stored_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, kind) for c, (_, kind, _) in zip(zip(*rows, strict=True), _STORED, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [name for name, *_ in _STORED])


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Documents as token ids with their keys, and what each task counted, in one pass.

    A document: ``doc_id``, ``ids`` as numbers of ``width`` bytes with the end id, their
    ``hash``, ``key0`` and so on. A row of ``width`` 0 holds a task's counts: in ``ids`` pairs
    of a token id and the number of documents with it; -1 stands for all documents, -2 for
    all tokens.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer)
        ranks = key_ranks(encoder.size)
        end = np.array([END_ID], "<u4").tobytes()
        frequency, n, total = np.zeros(encoder.size, np.int64), 0, 0
        for batch in slices(batches, ENCODED_AT_ONCE):
            rows = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch)), strict=True):
                ids = np.frombuffer(raw + end, "<u4")
                terms = np.unique(ids)
                frequency[terms] += 1
                n, total = n + 1, total + len(ids)
                width = 2 if terms[-1] < 1 << 16 else 4
                value = ids.astype(f"<u{width}").tobytes()
                digest = xxhash.xxh3_64_intdigest(value) >> 1
                rows.append((doc_id, width, value, digest, *content_keys(terms, ranks)))
            if rows:
                yield _stored_rows(rows)
        terms = np.flatnonzero(frequency)
        counts = np.stack([np.append(terms, [-1, -2]), np.append(frequency[terms], [n, total])], axis=1)
        yield _stored_rows([(None, 0, counts.astype("<i8").tobytes(), 0, *[-1] * KEYS)])

    wanted = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    schema = ", ".join(f"{name} {kind}" for name, _, kind in _STORED)
    return map_arrow(wanted, ["doc_id", "text"], encode, schema)


def _ids_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for width, raw in zip(batch.column("width").to_pylist(), batch.column("ids").to_pylist(), strict=True):
        yield np.frombuffer(raw, f"<u{width}").astype("<u4", copy=False)


def count_corpus(tokens: DataFrame) -> Corpus:
    """Frequencies over all documents, from the counts that the tasks stored."""

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                term, n = np.frombuffer(raw, "<i8").reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], ["term", "n"])

    rows = (
        map_arrow(tokens.filter("width = 0"), ["ids"], unpack, "term BIGINT, n BIGINT")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most one row per id of the vocabulary
    )
    counts = {row["term"]: row["n"] for row in rows}
    frequency = np.zeros(max([0, *counts]) + 1, np.int64)
    for term, n in counts.items():
        if term >= 0:
            frequency[term] = n
    return Corpus(counts.get(-1, 0), counts.get(-2, 0), frequency)


def dealt(tokens: DataFrame, corpus: Corpus, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``tokens`` (a stored table) in ranges of documents in the order of their keys."""
    ranges = max(1, -(-corpus.tokens // (shard_tokens * RANGE_SHARDS)))
    # rows alike in all but the place are interchangeable; it only spreads them
    order = [*_KEY_NAMES, "doc_id", "hash", "_place"]
    return (
        tokens.filter("width > 0")
        .withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "width", "ids")
    )


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of at most ``window`` tokens.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A sequence
    id holds the number of its task and its place among the task's sequences.
    """
    spark = docs.sparkSession
    tokens = staged(spark, encoded(docs, tokenizer or public_tokenizers.path(TOKENIZER_FILE)), "token-ids")
    corpus = count_corpus(tokens)
    shared = spark.sparkContext.broadcast(corpus)

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
        ids: list = []
        documents: list[np.ndarray] = []
        size = 0
        for batch in slices(batches):
            for doc_id, document in zip(batch.column("doc_id").to_pylist(), _ids_of(batch), strict=True):
                ids.append(doc_id)
                documents.append(document)
                size += len(document)
                if size >= shard_tokens:
                    yield ids, documents
                    ids, documents, size = [], [], 0
        if documents:
            yield ids, documents

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = TaskContext.get().partitionId() << 40
        for ids, documents in shards(batches):
            pieces = []
            for k, start, length, sequence, offset in pack(documents, window, shared.value):
                crc = zlib.crc32(documents[k][start : start + length].tobytes())
                pieces.append((ids[k], start, length, crc, len(documents[k]), sequences + sequence, offset))
            sequences += sequence + 1
            columns = zip(*pieces, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, (_, kind) in zip(columns, _PIECES, strict=True)],
                [name for name, _ in _PIECES],
            )

    return dealt(tokens, corpus, shard_tokens).mapInArrow(rows, _SCHEMA)


def op7_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 1,024 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
