"""Token ids in seekable files: one zstandard frame per document, a seek table at the end.

A file holds, one after another,

* a frame per document: its ids as little-endian unsigned 32-bit integers;
* a skippable frame with the doc_ids, in the order of the frames;
* the seek table of the public seekable format: for each frame its compressed size, its
  decompressed size and the low half of the XXH64 of its content, then a 9-byte footer.

A reader takes the footer, the table and the doc_ids, and then only the frames it wants.

Files are written by the tasks of one Spark job, each a range of doc_ids, so the files in
the order of their numbers hold the documents in ascending doc_id order. A task writes
under a name of its own attempt and renames at the end: a task that runs again, after its
executor was lost, replaces the file by the same bytes.

Null text counts as empty; a null doc_id comes first; rows that repeat a doc_id are written
one by one, ordered by text. A table without rows gives no documents. Other columns are not
read.
"""
import re
import struct
from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickrev.llm.arrow import map_arrow, slices, staged, texts_of
from clickrev.llm.tokens import END_ID, TOKENIZER_FILE, encoder_for
from clickrev.sources.files import join_path
from clickrev.sources.workspace import workspace

# Fixed values of the seekable format.
_SKIPPABLE_MAGIC = 0x184D2A50
_SEEK_TABLE_MAGIC = 0x184D2A5E
_FOOTER_MAGIC = 0x8F92EAB1
_CHECKSUM_FLAG = 0x80

_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
_DOC = np.dtype([("known", "u1"), ("doc_id", "<i8")])
_FOOTER = struct.Struct("<IBI")
_HEADER = struct.Struct("<II")

_MANIFEST_SCHEMA = "shard INT, file STRING, documents BIGINT, tokens BIGINT"
_DOCUMENT_SCHEMA = "shard INT, position BIGINT, doc_id BIGINT, first_token BIGINT, ids BINARY"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file named by Spark, and the path in it."""
    if ":" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class FrameWriter:
    """Writes one file, frame by frame."""

    def __init__(self, sink) -> None:
        self._sink = sink
        self._compressor = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self._entries: list[tuple[int, int, int]] = []
        self._docs: list[tuple[bool, int]] = []
        self.tokens = 0

    @property
    def documents(self) -> int:
        return len(self._docs)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        packed = self._compressor.compress(ids)
        self._sink.write(packed)
        checksum = xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF
        self._entries.append((len(packed), len(ids), checksum))
        self._docs.append((doc_id is not None, doc_id or 0))
        self.tokens += len(ids) // 4

    def finish(self) -> None:
        docs = np.array(self._docs, _DOC).tobytes()
        self._sink.write(_HEADER.pack(_SKIPPABLE_MAGIC, len(docs)) + docs)
        table = np.array(self._entries, _ENTRY).tobytes()
        footer = _FOOTER.pack(len(self._entries), _CHECKSUM_FLAG, _FOOTER_MAGIC)
        self._sink.write(_HEADER.pack(_SEEK_TABLE_MAGIC, len(table) + len(footer)) + table + footer)


class FrameReader:
    """Random access to the documents of one file."""

    def __init__(self, source) -> None:
        self._source = source
        end = source.size()
        count, flags, magic = _FOOTER.unpack(self._at(end - _FOOTER.size, _FOOTER.size))
        if magic != _FOOTER_MAGIC or flags != _CHECKSUM_FLAG:
            raise ValueError("not a token file: wrong footer")
        table_start = end - _FOOTER.size - count * _ENTRY.itemsize
        table = self._at(table_start, count * _ENTRY.itemsize)
        self._entries = np.frombuffer(table, _ENTRY)
        docs_start = table_start - _HEADER.size - count * _DOC.itemsize
        docs = np.frombuffer(self._at(docs_start, count * _DOC.itemsize), _DOC)
        self.doc_ids = [int(i) if known else None for known, i in docs]
        self._starts = np.concatenate([[0], np.cumsum(self._entries["packed"], dtype=np.int64)])
        self.first_tokens = np.concatenate(
            [[0], np.cumsum(self._entries["size"], dtype=np.int64) // 4]
        )

    def _at(self, start: int, length: int) -> bytes:
        self._source.seek(start)
        return self._source.read(length)

    def ids(self, position: int) -> bytes:
        """The ids of one document; only its frame is read and decompressed."""
        entry = self._entries[position]
        packed = self._at(int(self._starts[position]), int(entry["packed"]))
        ids = zstandard.decompress(packed)
        if len(ids) != entry["size"] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != entry["checksum"]:
            raise ValueError(f"damaged frame at position {position}")
        return ids


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str | None = None, shards: int | None = None
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write one file per range of doc_ids into ``folder``.

    Returns the manifest, staged as a table: ``shard, file, documents, tokens``. The only
    shuffle deals the texts out by ranges of doc_id; ``shards`` defaults to the session's
    number of shuffle partitions.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER_FILE)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"tokens-{shard:06d}.zst"
        attempt = f"{root}/.{name}-{uuid4().hex}"
        with store.open_output_stream(attempt) as sink:
            writer = FrameWriter(sink)
            for batch in slices(batches):
                encoded = encoder.encode(texts_of(batch))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                    writer.add(doc_id, ids + end)
            writer.finish()
        if not writer.documents:
            store.delete_file(attempt)
            return
        store.move(attempt, f"{root}/{name}")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()),
                pa.array([join_path(folder, name)]),
                pa.array([writer.documents], pa.int64()),
                pa.array([writer.tokens], pa.int64()),
            ],
            ["shard", "file", "documents", "tokens"],
        )

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return staged(spark, ordered.mapInArrow(write, _MANIFEST_SCHEMA), "token-files")


def read_token_files(manifest: DataFrame, doc_ids: set[int] | None = None) -> DataFrame:
    """``shard, position, doc_id, first_token, ids`` of the documents in the files.

    ``doc_ids`` picks documents; no other frame is decompressed. One task reads a file.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_store(row["file"])
                with store.open_input_file(path) as source:
                    yield from _documents(FrameReader(source), row["shard"], doc_ids)

    files = max(1, manifest.count())
    spread = manifest.select("shard", "file").repartitionByRange(files, "shard")
    return spread.mapInArrow(read, _DOCUMENT_SCHEMA)


def _documents(
    reader: FrameReader, shard: int, doc_ids: set[int] | None, bytes_at_once: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    names = ["shard", "position", "doc_id", "first_token", "ids"]
    rows: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    for position, doc_id in enumerate(reader.doc_ids):
        if doc_ids is None or doc_id in doc_ids:
            ids = reader.ids(position)
            rows.append((shard, position, doc_id, int(reader.first_tokens[position]), ids))
            size += len(ids)
            if size > bytes_at_once:
                yield batch()
                rows, size = [], 0
    if rows:
        yield batch()


def with_global_start(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all documents before this one, over all files.

    The running sum is over the files of the manifest, one row each.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select(
        "shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("_offset")
    )
    return (
        documents.join(F.broadcast(offsets), "shard")
        .withColumn("start", F.col("_offset") + F.col("first_token"))
        .drop("_offset")
    )


def op9_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to files and read back from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = write_token_files(docs, workspace(spark, "tokens"))
    documents = with_global_start(read_token_files(manifest), manifest)
    return documents.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
