"""Importance resampling: keep the texts a target model prefers over the raw model.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. The raw
model has the buckets' shares over all documents; the target model those over documents
labelled good. A document's log-weight is the sum, over its n-grams, of the logarithm of
the ratio of the two. Adding Gumbel noise and keeping the k largest keys draws k documents
without replacement, with chances in proportion to their weights.

A few toxic words in a long text do not outweigh its other n-grams in that sum, so toxicity
is a decision of its own. For each bucket of a second, finer hashing of words the share of toxic ones
among the labelled documents that hold it is taken, drawn towards the share of all labelled
documents; equal texts count once. A document's toxicity is the largest share of its
buckets. From ``TOXIC_AT`` on it is toxic and never drawn, labelled or not. Unless the
caller gives a share, that of the labelled documents that are good and not toxic is drawn.

The noise comes from a hash of seed, doc_id and text, so a task that runs again draws the
same. The k-th key is found by counting keys in ever finer bins, not by sorting: a few
passes over one number per document. Ties at the k-th key go to the smaller doc_id, then to
the smaller hash of the text; rows alike in all of these are taken together.

Null or empty text has no n-gram and log-weight 0. Without labelled rows every log-weight
is 0, no document is toxic and all are drawn. Labels without a document, repeated labels and other columns have no effect.
"""
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import map_arrow, slices, staged, texts_of
from clickrev.llm.words import WORD_HASHES, WordHashes, rolling

BUCKETS = 10_000
SMOOTHING = 1.0
#: The target model is fitted on at most this many labelled documents, picked by a hash of
#: their ids; everything else covers all documents.
TARGET_SAMPLE = 20_000
TOXIC_BUCKETS = 1 << 20
#: So many labelled documents of the average share are added to those with a bucket.
TOXIC_PRIOR = 10.0
TOXIC_AT = 0.5
_BINS = 4096


class _BareHashes(WordHashes):
    """Hashes of words without the signs around them."""

    def __missing__(self, word: str) -> int:
        bare = _SIGNS_AROUND.sub("", word)
        return super().__missing__(word) if bare == word or not bare else self._keep(word, bare)

    def _keep(self, word: str, bare: str) -> int:
        self[word] = value = self[bare]
        return value


_SIGNS_AROUND = re.compile(r"^\W+|\W+$")
_BARE_HASHES = _BareHashes()


def toxic_ids(text: str) -> np.ndarray:
    """The different buckets of the toxic model in a text, of its words alone."""
    grams = rolling(_BARE_HASHES.of(text.lower().split()), 1)
    return np.unique((grams % np.uint64(TOXIC_BUCKETS)).astype(np.int64))


def bucket_ids(text: str) -> np.ndarray:
    """Buckets of all words and pairs of words of a text."""
    hashes = WORD_HASHES.of(text.lower().split())
    grams = np.concatenate([rolling(hashes, 1), rolling(hashes, 2)])
    return (grams % np.uint64(BUCKETS)).astype(np.int64)


def target_ids(labels: DataFrame, at_most: int = TARGET_SAMPLE) -> list[int]:
    """doc_ids labelled good and not toxic, a bounded sample in the order of a hash."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").distinct()
    rows = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most).collect()
    return [row["doc_id"] for row in rows if row["doc_id"] is not None]


def fit_log_ratio(docs: DataFrame, targets: list[int]) -> np.ndarray:
    """Per bucket the logarithm of target share over raw share.

    Tasks count into two fixed arrays and send these; one pass over the texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.array(sorted(targets), np.int64))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches):
            ids = np.array([-1 if i is None else i for i in batch.column("doc_id").to_pylist()])
            grams = [bucket_ids(text) for text in texts_of(batch)]
            for model, chosen in ((0, np.ones(len(ids), bool)), (1, np.isin(ids, wanted))):
                picked = [g for g, yes in zip(grams, chosen, strict=True) if yes]
                if picked:
                    counts[model] += np.bincount(np.concatenate(picked), minlength=BUCKETS)
        model, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(model, pa.int32()), pa.array(bucket, pa.int32()), pa.array(counts[model, bucket])],
            ["model", "bucket", "n"],
        )

    rows = (
        map_arrow(docs, ["doc_id", "text"], count, "model INT, bucket INT, n BIGINT")
        .groupBy("model", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # two rows a bucket at most
    )
    counts = np.zeros((2, BUCKETS))
    counts[rows["model"], rows["bucket"]] = rows["n"]
    if not counts[1].any():
        return np.zeros(BUCKETS)
    shares = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(shares[1] / shares[0])


def good_share(labels: DataFrame) -> float:
    """Share of the labelled documents that are good and not toxic, 1 without labels."""
    good = F.max((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    by_document = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.coalesce(good, F.lit(False)).alias("good"))
    share = by_document.agg(F.avg(F.col("good").cast("double"))).first()[0]
    return 1.0 if share is None else share


def fit_toxicity(docs: DataFrame, labels: DataFrame, at_most: int = TARGET_SAMPLE) -> np.ndarray:
    """Per bucket the smoothed share of toxic ones among the labelled documents with it.

    Fitted on at most so many toxic and so many other documents.
    """
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    toxic, other = (
        known.filter(kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)
        for kind in (F.col("toxic") == 1, F.col("toxic") != 1)
    )
    labelled = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(toxic.unionByName(other)), "doc_id")
        .groupBy(F.xxhash64("text").alias("hash"))
        .agg(F.first("text").alias("text"), F.max("toxic").cast("int").alias("toxic"))
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, TOXIC_BUCKETS + 1), np.int64)
        for batch in slices(batches):
            for text, kind in zip(texts_of(batch), batch.column("toxic").to_pylist(), strict=True):
                counts[int(kind == 1), toxic_ids(text)] += 1
                counts[int(kind == 1), TOXIC_BUCKETS] += 1  # all documents
        kind, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(counts[kind, bucket])],
            ["kind", "bucket", "n"],
        )

    rows = (
        map_arrow(labelled, ["text", "toxic"], count, "kind INT, bucket INT, n BIGINT")
        .groupBy("kind", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # two rows a bucket at most
    )
    counts = np.zeros((2, TOXIC_BUCKETS + 1))
    counts[rows["kind"], rows["bucket"]] = rows["n"]
    average = counts[1, -1] / max(counts[:, -1].sum(), 1.0)
    shares = (counts[1] + TOXIC_PRIOR * average) / (counts.sum(axis=0) + TOXIC_PRIOR)
    return shares[:-1] if counts[1, -1] else np.zeros(TOXIC_BUCKETS)


def log_weights(
    docs: DataFrame, log_ratio: np.ndarray, seed: int = 0, toxicity: np.ndarray | None = None
) -> DataFrame:
    """``doc_id, log_weight, gumbel_key, text_hash, toxicity`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(log_ratio)
    any_toxic = toxicity is not None and toxicity.any()
    shared_toxicity = docs.sparkSession.sparkContext.broadcast(toxicity if any_toxic else None)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, toxic = shared.value, shared_toxicity.value
        for batch in slices(batches):
            texts = texts_of(batch)
            weights = [float(ratio[bucket_ids(text)].sum()) for text in texts]
            highest = [0.0 if toxic is None else float(toxic[toxic_ids(text)].max(initial=0.0)) for text in texts]
            numbers = [pa.array(weights, pa.float64()), pa.array(highest, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "text_hash", "noise")), *numbers],
                ["doc_id", "text_hash", "noise", "log_weight", "toxicity"],
            )

    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("text_hash"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("noise"),
    )
    # 52 bits of the hash as a number strictly between 0 and 1
    uniform = (F.shiftrightunsigned("noise", 12) + 0.5) / float(1 << 52)
    return (
        hashed.mapInArrow(weigh, "doc_id BIGINT, text_hash BIGINT, noise BIGINT, log_weight DOUBLE, toxicity DOUBLE")
        .withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
        .select("doc_id", "log_weight", "gumbel_key", "text_hash", "toxicity")
    )


def with_top_k(weights: DataFrame, k: int) -> DataFrame:
    """Add ``selected``: true for the k rows of the largest keys.

    ``weights`` must be a stored table. Each round counts the keys of one bin in 4,096 finer
    ones, until a bin holds one key or no number lies between its ends.
    """
    low, high, total = weights.agg(F.min("gumbel_key"), F.max("gumbel_key"), F.count(F.lit(1))).first()
    if k >= total or k <= 0:
        return weights.withColumn("selected", F.lit(k > 0 and k >= total))
    left = k  # still to be taken from the bin [low, high]
    while True:
        width = (high - low) / _BINS
        if width <= 0 or low + width == low:
            break
        place = F.least(F.floor((F.col("gumbel_key") - low) / width), F.lit(_BINS - 1))
        rows = (
            weights.filter(F.col("gumbel_key").between(low, high))
            .groupBy(place.alias("place"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("gumbel_key").alias("low"), F.max("gumbel_key").alias("high"))
            .collect()  # at most one row a bin
        )
        for row in sorted(rows, key=lambda row: -row["place"]):
            if left <= row["n"]:
                low, high, found = row["low"], row["high"], row["n"]
                break
            left -= row["n"]
        if found == left:  # the whole bin is taken
            return weights.withColumn("selected", F.col("gumbel_key") >= low)
        if found == 1:
            break
    # rows alike in their keys: `left` of those in [low, high] by doc_id
    tied = weights.filter(F.col("gumbel_key").between(low, high))
    order = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.col("text_hash").alias("hash"))
    last = tied.select(order.alias("place")).orderBy("place").limit(left).agg(F.max("place")).first()[0]
    end = F.struct(F.lit(last["id"]).cast("long").alias("id"), F.lit(last["hash"]).cast("long").alias("hash"))
    taken = (F.col("gumbel_key") >= low) & (order <= end)
    return weights.withColumn("selected", (F.col("gumbel_key") > high) | taken)


def importance_sample(
    docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 0
) -> DataFrame:
    """``doc_id, log_weight, gumbel_key, toxicity, selected``: draw a share of the documents.

    Without a ``share``, that of the labels; fewer are drawn if more are toxic.
    """
    spark = docs.sparkSession
    ratio = fit_log_ratio(docs, target_ids(labels))
    weights = staged(spark, log_weights(docs, ratio, seed, fit_toxicity(docs, labels)), "weights")
    k = round((good_share(labels) if share is None else share) * weights.count())
    toxic = F.col("toxicity") >= TOXIC_AT
    drawn = with_top_k(weights.filter(~toxic), k)
    return drawn.unionByName(weights.filter(toxic).withColumn("selected", F.lit(False))).drop("text_hash")


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight, its key and whether it was drawn."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return importance_sample(docs, labels)
