"""Benchmark passages in documents, by q-gram counting in diagonal bands and banded alignment.

Texts are compared as their letters and digits in lower case. A benchmark item of m such
characters is found where at most ``k = floor(MAX_ERROR * m)`` insertions, deletions and
replacements turn it into a part of the document. By the q-gram lemma such a part shares at
least ``m - q + 1 - k * q`` q-grams with the item, all within k diagonals of each other,
a diagonal being the place in the document less the place in the item. Shared q-grams are
counted per item in bands of diagonals that overlap by half, each twice as wide as needed,
so every run of k + 1 neighbouring diagonals lies in one band. Bands that reach the bound
are verified by an alignment restricted to the band.

An item of more than ``WINDOW`` characters is also looked for in parts: in windows of so many
characters, one every half window, each an item of its own with its own bound. So every part
of at least one and a half windows that a document repeats holds a whole window and is
found. Windows found where the document's places overlap make one region; those inside a
whole item found are that item.

For items so short that the bound would be less than one, k is lowered until it is one; an
item of fewer than q letters and digits is found by plain search, as a whole document only
(elsewhere its few letters mean nothing).

The benchmark is read in blocks of bounded size; each block's index is broadcast and the
documents are scanned once per block. Documents are never shuffled.

A region has ``share``, the part of the item's characters that its windows cover (1.0 for a
whole item), and as ``edits`` those of its worst window. An item has its best whole place, the
first of several, and every region outside of it.

Null or empty texts match nothing; so does an item without letters and digits. Repeated
rows are reported one by one. Other columns pass through ``decontaminate``.
"""
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import slices, texts_of
from clickrev.llm.words import MIX_A, mixed

Q = 10
MAX_ERROR = 0.08
#: Letters and digits in a window of a longer item; windows begin every half of it.
WINDOW = 160
#: Characters of benchmark text in one broadcast index.
BLOCK_CHARS = 4_000_000
_BITMAP_BITS = 22

_case_table: list[np.ndarray] = []


def _lower_table() -> np.ndarray:
    """For each code point its lower-case letter or digit, 0 for anything else."""
    if not _case_table:
        table = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            letter = chr(code)
            if letter.isalnum():
                low = letter.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _case_table.append(table)
    return _case_table[0]


def normalized(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letters and digits of a text, and their places in it."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    lowered = _lower_table()[codes]
    places = np.flatnonzero(lowered)
    return lowered[places], places


def qgrams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of each q-gram."""
    count = len(codes) - q + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    # spans of 1, 2, 4, ... characters put together to one of q
    wide, width = codes.astype(np.uint64), 1
    value, done = None, 0
    factor = np.array([MIX_A])
    while True:
        if q & width:
            part = wide[done : done + count] if value is not None else wide[:count]
            value = part if value is None else value * factor + part
            done += width
        if 2 * width > q:
            return mixed(value)
        wide = wide[:-width] * factor + wide[width:]
        width *= 2
        factor = factor * MIX_A


@dataclass(frozen=True)
class Item:
    item_id: int
    codes: np.ndarray
    budget: int  # edits allowed
    least: int  # q-grams that must be shared in a band


def _item(item_id: int, codes: np.ndarray, q: int, max_error: float) -> Item:
    m = len(codes)
    budget = max(0, min(int(max_error * m), (m - q) // q))
    return Item(item_id, codes, budget, m - q + 1 - budget * q)


def item_of(item_id: int, text: str, q: int = Q, max_error: float = MAX_ERROR) -> Item:
    return _item(item_id, normalized(text)[0], q, max_error)


def window_starts(length: int, window: int = WINDOW) -> list[int]:
    """Where the windows of an item begin; the last one ends with the item."""
    if length <= window:
        return []
    return [*range(0, length - window, window // 2), length - window]


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[Item], q: int = Q, max_error: float = MAX_ERROR) -> None:
        self.q = q
        self.short = [item for item in items if 0 < len(item.codes) < q]
        self.items = [item for item in items if len(item.codes) >= q]
        # whole items first, then their windows: of which item, and where in it
        self.wholes = len(self.items)
        self.window_of = [
            (k, start) for k in range(self.wholes) for start in window_starts(len(self.items[k].codes))
        ]
        self.items += [
            _item(self.items[k].item_id, self.items[k].codes[start : start + WINDOW], q, max_error)
            for k, start in self.window_of
        ]
        grams = [qgrams(item.codes, q) for item in self.items]
        keys = np.concatenate([*grams, np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*[np.arange(len(g)) for g in grams], np.empty(0, np.int64)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.place = keys[order], owner[order], place[order].astype(np.int64)
        self.bitmap = np.zeros(1 << _BITMAP_BITS, bool)
        self.bitmap[(keys >> np.uint64(64 - _BITMAP_BITS)).astype(np.int64)] = True
        self.budgets = np.array([item.budget for item in self.items], np.int64)
        self.least = np.array([item.least for item in self.items], np.int64)
        self.fewest = int(self.least.min()) if self.items else 0

    def find(self, text: str) -> list[tuple[int, int, int, int, float]]:
        """``(item_id, start, end, edits, share)`` of every item and region found in a text."""
        codes, places = normalized(text)
        best: dict[int, tuple[int, int, int]] = {}
        windows: dict[int, list[tuple[int, int, int, int]]] = {}
        for k, low in self._bands(codes):
            item = self.items[k]
            high = low + 2 * self._band(k)
            if k >= self.wholes:
                # bands of whole items come first
                whole, at = self.window_of[k - self.wholes]
                if whole in best and best[whole][1] <= low + item.budget and high - item.budget + len(item.codes) <= best[whole][2]:
                    continue
            edits, start, end = align(codes, item.codes, low, high, item.budget)
            if edits > item.budget:
                continue
            if k >= self.wholes:
                windows.setdefault(whole, []).append((start, end, at, edits))
            elif k not in best or (edits, start) < best[k][:2]:
                best[k] = (edits, start, end)
        found = [(item.item_id, 0, len(codes), 0, 1.0) for item in self.short if np.array_equal(codes, item.codes)]
        for k, item in enumerate(self.items[: self.wholes]):
            whole = best.get(k)
            if whole:
                found.append((item.item_id, whole[1], whole[2], whole[0], 1.0))
            outside = [w for w in windows.get(k, []) if not whole or w[1] <= whole[1] or whole[2] <= w[0]]
            for start, end, edits, covered in regions(outside):
                found.append((item.item_id, start, end, edits, covered / len(item.codes)))
        return [
            (item_id, int(places[start]), int(places[end - 1]) + 1, edits, share)
            for item_id, start, end, edits, share in found
        ]

    def _band(self, k: int) -> int:
        """Half the width of a band of item k."""
        return int(self.budgets[k]) + 1

    def _bands(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Items and the lowest diagonal of each band with enough shared q-grams."""
        if not self.items or len(codes) < self.q:
            return
        grams = qgrams(codes, self.q)
        hits = np.flatnonzero(self.bitmap[(grams >> np.uint64(64 - _BITMAP_BITS)).astype(np.int32)])
        if len(hits) < self.fewest:
            return
        grams = grams[hits]
        first, last = np.searchsorted(self.keys, grams, "left"), np.searchsorted(self.keys, grams, "right")
        many = last - first
        if int(many.sum()) < self.fewest:
            return
        entry = np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        owner, diagonal = self.owner[entry], np.repeat(hits, many) - self.place[entry]
        half = self.budgets[owner] + 1
        shift = 1 << 40  # diagonals may be negative
        band = (diagonal + shift * half) // half
        # a hit counts for the band that starts at its half and for the one before
        keys = np.concatenate([owner * (1 << 42) + band, owner * (1 << 42) + band - 1])
        # the same place of the document counts once per band
        pairs = np.unique(np.stack([keys, np.concatenate([np.repeat(hits, many)] * 2)]), axis=1)
        bands, counts = np.unique(pairs[0], return_counts=True)
        for key, count in zip(bands.tolist(), counts.tolist(), strict=True):
            k = key >> 42
            if count >= self.least[k]:
                half_k = int(self.budgets[k]) + 1
                yield k, ((key & ((1 << 42) - 1)) - shift) * half_k


def regions(windows: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """``start, end, edits, covered`` of windows ``(start, end, place in the item, edits)`` that overlap.

    ``covered`` counts the item's characters in any of the windows.
    """
    region: list[tuple[int, int, int, int]] = []
    end = 0
    for window in [*sorted(windows), None]:
        if region and (window is None or window[0] >= end):
            covered, until = 0, 0
            for at in sorted(at for _, _, at, _ in region):
                covered += at + WINDOW - max(at, until)
                until = at + WINDOW
            yield region[0][0], end, max(edits for *_, edits in region), covered
            region, end = [], 0
        if window:
            region.append(window)
            end = max(end, window[1])


def align(codes: np.ndarray, item: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int]:
    """Fewest edits that turn the item into a part of ``codes`` within diagonals low to high.

    Returns edits, start and end of the part. Row by row over the item; the cell of diagonal
    d in row i is place i + d of the document.
    """
    low, high = low - budget, high + budget
    width = high - low + 1
    m, n = len(item), len(codes)
    # an exact copy needs no table
    for d in range(max(low, 0), min(high, n - m) + 1):
        if codes[d] == item[0] and np.array_equal(codes[d : d + m], item):
            return 0, d, d + m
    far = m + n + 1
    diagonals = np.arange(low, high + 1)
    steps = np.arange(width)
    cost = np.where((diagonals >= 0) & (diagonals <= n), 0, far)
    start = diagonals.copy()
    padded = np.concatenate([codes, np.zeros(1, codes.dtype)])
    for i in range(1, m + 1):
        at = diagonals + i  # characters of the document used by then
        inside = (at >= 1) & (at <= n)
        same = inside & (padded[np.clip(at - 1, 0, n)] == item[i - 1])
        diagonal_cost = np.where(inside, cost + ~same, far)
        above = np.append(cost[1:] + 1, far)  # an item's character left out
        take_above = above < diagonal_cost
        new = np.where(take_above, above, diagonal_cost)
        new_start = np.where(take_above, np.append(start[1:], 0), start)
        # extra characters of the document: a running minimum along the row
        slope = new - steps
        source = np.maximum.accumulate(np.where(slope == np.minimum.accumulate(slope), steps, 0))
        cost = np.where((at >= 0) & (at <= n), new[source] + steps - source, far)
        start = new_start[source]
        if cost.min() > budget:
            return budget + 1, 0, 0
    best = int(np.argmin(cost))
    return int(cost[best]), int(start[best]), int(diagonals[best] + m)


def blocks_of(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[Item]]:
    """The items in blocks of bounded size, read one block at a time.

    A block holds ``block_chars`` characters, or one item that is longer.
    """
    spark = benchmark.sparkSession
    sizes = benchmark.select(F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-2 * total // block_chars))
    split = benchmark.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        rows = split.filter(F.col("_block") == block).select("item_id", "text").toLocalIterator()
        yield [item_of(row["item_id"], row["text"] or "") for row in rows]


_FOUND = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "item_id", "start", "end", "edits")] + [("share", pa.float64())]
)


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, end, edits, share``: items and regions of them in documents.

    Offsets are code points of the document's text.
    """
    schema = "doc_id BIGINT, item_id BIGINT, start BIGINT, end BIGINT, edits BIGINT, share DOUBLE"
    context = docs.sparkSession.sparkContext
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    result = None
    for items in blocks_of(benchmark):
        shared = context.broadcast(items)

        def find(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in slices(batches):
                rows = [
                    (doc_id, *match)
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True)
                    for match in index.find(text)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND, strict=True)], schema=_FOUND
                    )

        found = wanted.mapInArrow(find, schema)
        result = found if result is None else result.unionByName(found)
    return result


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, or a window of one."""
    context = docs.sparkSession.sparkContext
    schema = docs.schema
    for items in blocks_of(benchmark):
        shared = context.broadcast(items)

        def keep(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in slices(batches):
                clean = [not index.find(text) for text in texts_of(batch)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, schema)
    return docs


def op5_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items, and regions of them, found in any document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
