"""Spelling variants of words: pairs one edit apart, each word's commoner form, its root.

A word's letter multiset is a binary vector: one place for every letter and number of its
occurrence. One inserted, deleted or replaced code point changes at most two places. The
places are dealt into ``PARTS`` parts by a hash; vectors at most two places apart agree in
all parts but two, so each choice of two parts to leave out gives a signature of the
others, and two such words have at least one signature in common. A signature also holds
the first or the last letters of the word, as many as one edit cannot touch at both ends,
which splits the buckets of words made of the same letters. Words of one signature meet in
an equi-join and stay a pair if their edit distance is exactly one. Signatures are 64-bit
hashes; a chance agreement only adds a pair to verify, so no pair is lost.

A word's form is its near word of the largest count, then the smallest in code-point order,
if that count is at least ``RATIO`` times its own. Counts grow along forms, so the chain of
forms ends; pointers are doubled until none moves.

Words are runs of the letters A to Z and U+00C0 to U+00FF, with A to Z in lower case. Null
and empty texts have none. A repeated row counts again.
"""
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import map_arrow, slices, staged, texts_of
from clickrev.llm.words import MIX_A, mixed

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
PARTS = 5
_FLUSH_WORDS = 300_000


# --- Words of documents --------------------------------------------------------

Edit = Callable[[int | None, bytes], bytes]


def with_slips(doc_id: int | None, word: bytes) -> bytes:
    """The word, in one of 31 cases by a hash of id and word, without one of its letters.

    A document without an id has none of these.
    """
    if doc_id is None:
        return word
    utf8 = word if word.isascii() else word.decode("latin-1").encode()
    h = zlib.crc32(utf8, zlib.crc32(b"%d:" % doc_id))
    if h % 31:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def word_counts(docs: DataFrame, least: int = LEAST_LETTERS, edit: Edit | None = None) -> DataFrame:
    """``word, n`` of the words of at least so many letters in ``docs`` (doc_id, text).

    Every task sums up its own counts, in pieces of a bounded size, before the shuffle.
    """
    # the letters are those of Latin-1, so a byte stands for a code point
    pattern = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least)

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = [word.decode("latin-1") for word in counts]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                letters = text.encode("latin-1", "replace").lower()  # bytes.lower: A to Z only
                for word, n in Counter(pattern.findall(letters)).items():
                    if edit:
                        word = edit(doc_id, word)
                        if len(word) < least:
                            continue
                    counts[word] += n
                if len(counts) > _FLUSH_WORDS:
                    yield batch_of(counts)
                    counts = Counter()
        if counts:
            yield batch_of(counts)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    counted = map_arrow(rows, ["doc_id", "text"], count, "word STRING, n BIGINT")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# --- Pairs ---------------------------------------------------------------------


class _Places(dict):
    """Part and value of a vector's place: a letter and the number of its occurrence."""

    def __missing__(self, place: tuple[str, int]) -> tuple[int, int]:
        name = f"{place[0]}{place[1]}".encode("utf-8", "surrogatepass")
        self[place] = value = (
            xxhash.xxh3_64_intdigest(name, 1) % PARTS,
            xxhash.xxh3_64_intdigest(name, 2),
        )
        return value


_PLACES = _Places()


def part_sums(word: str) -> list[int]:
    """For each part the sum of the values of the word's places in it."""
    sums = [0] * PARTS
    seen: dict[str, int] = {}
    for letter in word:
        seen[letter] = k = seen.get(letter, 0) + 1
        part, value = _PLACES[letter, k]
        sums[part] += value
    return [total & 0xFFFFFFFFFFFFFFFF for total in sums]


_LEFT_OUT = list(combinations(range(PARTS), 2))


def signatures(words: list[str], least: int = LEAST_LETTERS) -> np.ndarray:
    """A row of signatures for each word of at least ``least`` code points."""
    ends = (least - 1) // 2
    sums = np.array([part_sums(word) for word in words], np.uint64).reshape(-1, PARTS)
    parts = mixed(sums + np.arange(1, PARTS + 1, dtype=np.uint64) * MIX_A)
    total = parts.sum(axis=1)
    kept = np.stack([total - parts[:, a] - parts[:, b] for a, b in _LEFT_OUT], axis=1)
    kept += np.arange(len(_LEFT_OUT), dtype=np.uint64)
    out = []
    for side, cut in ((3, slice(0, ends)), (4, slice(-ends, None) if ends else slice(0, 0))):
        digests = [xxhash.xxh3_64_intdigest(w[cut].encode("utf-8", "surrogatepass"), side) for w in words]
        out.append(mixed(kept * MIX_A + np.array(digests, np.uint64)[:, None]))
    return np.concatenate(out, axis=1).view(np.int64)


def near_pairs(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """``a, a_n, b, b_n``: each pair a < b of ``words`` (word, n; distinct) one edit apart, once.

    Words shorter than ``least`` code points have no part in it.
    """

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            table = signatures(batch.column("word").to_pylist(), least)
            repeats = pa.array(np.repeat(np.arange(len(table)), table.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(table.ravel()), *(batch.column(c).take(repeats) for c in ("word", "n"))],
                ["signature", "word", "n"],
            )

    long_enough = words.filter(F.char_length("word") >= least)
    signed = map_arrow(long_enough, ["word", "n"], sign, "signature BIGINT, word STRING, n BIGINT")
    a, b = signed.alias("a"), signed.alias("b")
    close = F.abs(F.char_length("a.word") - F.char_length("b.word")) <= 1
    one_edit = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    ordered = F.col("a.word") < F.col("b.word")
    return (
        a.join(b, (F.col("a.signature") == F.col("b.signature")) & ordered & close & one_edit)
        .select(
            F.col("a.word").alias("a"),
            F.col("a.n").alias("a_n"),
            F.col("b.word").alias("b"),
            F.col("b.n").alias("b_n"),
        )
        .distinct()
    )


# --- Forms and roots -----------------------------------------------------------


def roots_of(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms`` (word, form; one row a word, no cycle): the last form.

    Every round doubles how far a pointer reaches and is written as a table.
    """
    spark = forms.sparkSession
    current = staged(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        if current.join(onward, F.col("root") == F.col("_at"), "left_semi").isEmpty():
            return current
        moved = current.join(onward, F.col("root") == F.col("_at"), "left")
        current = staged(spark, moved.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def variant_forms(words: DataFrame, least: int = LEAST_LETTERS, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of ``words`` (word, n).

    Equal words count as one with the sum of their counts; a null word has no form.
    """
    spark = words.sparkSession
    words = staged(spark, words.groupBy("word").agg(F.sum("n").alias("n")), "words")
    pairs = near_pairs(words.filter("word IS NOT NULL"), least)
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("word")))
    near = (
        pairs.select(F.explode(both).alias("p"))
        .select("p.*")
        .groupBy("word", "n")
        .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    )
    common = -F.col("best.minus_n") >= ratio * F.col("n")
    near = staged(
        spark,
        near.select(
            F.col("word").alias("_word"),
            "n_near",
            F.when(common, F.col("best.word")).alias("form"),
            F.when(common, -F.col("best.minus_n")).alias("form_n"),
        ),
        "near",
    )
    roots = roots_of(near.filter("form IS NOT NULL").select(F.col("_word").alias("word"), "form"))
    known = near.join(roots.withColumnRenamed("word", "_of"), F.col("_word") == F.col("_of"), "left")
    return words.join(known, F.col("word") == F.col("_word"), "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )


def op13_partenum_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some with a slip, their near words, forms and roots."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = word_counts(docs, edit=with_slips).filter(F.col("n") >= LEAST_COUNT)
    return variant_forms(words)
