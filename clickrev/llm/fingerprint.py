"""Document fingerprints: a digest of bucket quartiles.

All byte triplets of a sliding window of five bytes that hold the window's first byte are
hashed into 256 buckets. The digest keeps, for each bucket, in which quartile of all bucket
counts its count lies (two bits), the logarithm of the length, and two ratios of the
quartiles. Two digests differ by a score: bucket by bucket the distance of the quartiles,
opposite ends counting double, plus the differences of length and ratios. The score has an
upper bound, so ``likeness`` maps it to 0 (that bound) to 1 (no difference).

Null and empty text have the digest of no bytes. A text shorter than the window is filled
up with zero bytes. Equal texts have equal digests, whatever their rows.
"""
import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clickrev.llm.arrow import slices
from clickrev.llm.ranges import with_successor_ranges

BUCKETS = 256
WINDOW = 5
_MAX_LENGTH_DIFFERENCE = 48
_MAX_RATIO_DIFFERENCE = 12
#: Largest possible difference of two digests.
MAX_DIFFERENCE = 6 * BUCKETS + _MAX_LENGTH_DIFFERENCE + 2 * _MAX_RATIO_DIFFERENCE

# One random byte per position and byte value, from a fixed seed: their exclusive or is the
# hash of a triplet. The kinds of triplet differ by a constant.
_TABLES = np.random.default_rng(20240601).permuted(
    np.tile(np.arange(256, dtype=np.uint8), (3, 1)), axis=1
)
_TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
_SALTS = np.array([0, 97, 193, 41, 137, 233], np.uint8)
_STRIDE = 1 << 18


def bucket_counts(data: bytes) -> np.ndarray:
    """Counts of the hashed triplets of all windows."""
    values = np.frombuffer(data.ljust(WINDOW, b"\0"), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(values) - WINDOW + 1, _STRIDE):
        part = values[start : start + _STRIDE + WINDOW - 1]
        n = len(part) - WINDOW + 1
        first, second, third = (table[part] for table in _TABLES)
        for (i, j), salt in zip(_TRIPLETS, _SALTS, strict=True):
            code = first[:n] ^ second[i : i + n] ^ third[j : j + n]
            kind = np.bincount(code, minlength=BUCKETS)
            counts += kind[np.arange(BUCKETS) ^ int(salt)]
    return counts


def fingerprint(text: str | None) -> str:
    """The digest of a text: 132 hexadecimal digits."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = bucket_counts(data)
    q1, q2, q3 = (int(q) for q in np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]])
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = min(255, round(math.log(len(data) + 1) / math.log(1.1)))
    ratios = [q * 15 // q3 if q3 else 0 for q in (q1, q2)]
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    return bytes([length, ratios[0] << 4 | ratios[1]]).hex() + packed.tobytes().hex()


def difference(left: str, right: str) -> int:
    """How far two digests are apart, 0 to ``MAX_DIFFERENCE``."""
    a, b = (np.frombuffer(bytes.fromhex(digest), np.uint8) for digest in (left, right))
    length = min(_MAX_LENGTH_DIFFERENCE, abs(int(a[0]) - int(b[0])))
    ratios = sum(
        min(_MAX_RATIO_DIFFERENCE, abs((int(a[1]) >> shift & 15) - (int(b[1]) >> shift & 15)))
        for shift in (0, 4)
    )
    body = 0
    for shift in (0, 2, 4, 6):
        apart = np.abs((a[2:] >> shift & 3).astype(np.int64) - (b[2:] >> shift & 3))
        body += int(apart.sum() + 3 * (apart == 3).sum())
    return body + length + ratios


def likeness(left: str, right: str) -> float:
    """1 for equal digests, 0 for the largest possible difference."""
    return 1.0 - difference(left, right) / MAX_DIFFERENCE


_COMPARED_SCHEMA = (
    "doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, "
    "edited_fingerprint STRING, near_edited DOUBLE, near_next DOUBLE"
)
_COMPARED = [
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]


def compare_with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprint ``docs`` (doc_id, text), and compare with an edited text and the next document.

    The next document is that with the next smaller doc_id; the last one's is the first.
    The edited text has its last half replaced by as much of the next document's start.
    One shuffle by ranges of doc_id; a task holds two texts beside its batch.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (range, doc_id, text, digest) of a row whose next is not known yet
        for batch in slices(batches):
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("_range", "_borrowed", "doc_id", "text")]
            for place, borrowed, doc_id, text in zip(*columns, strict=True):
                text = text or ""
                digest = fingerprint(text)
                if waiting and waiting[0] == place:
                    rows.append(_compared(*waiting[1:], text, digest))
                waiting = None if borrowed else (place, doc_id, text, digest)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values, kind)
                        for values, (_, kind) in zip(zip(*rows, strict=True), _COMPARED, strict=True)
                    ],
                    [name for name, _ in _COMPARED],
                )

    dealt = with_successor_ranges(docs.select("doc_id", "text"), ranges)
    return dealt.mapInArrow(compare, _COMPARED_SCHEMA)


def _compared(doc_id: int | None, text: str, digest: str, next_text: str, next_digest: str) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + next_text[:half]
    edited_digest = digest if edited == text else fingerprint(edited)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id,
        len(text),
        sha,
        digest,
        edited_digest,
        likeness(digest, edited_digest),
        likeness(digest, next_digest),
    )


def op1_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edited text and its neighbour compared."""
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
