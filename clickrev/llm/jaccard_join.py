"""N-gram Jaccard join by chosen paths.

Documents are sets of hashed shingles of five words; two are linked if the Jaccard
similarity of their sets reaches the threshold. Equal sets are put together first, by a
64-bit digest of the set (n distinct sets have a false match with a chance of n^2 / 2^65).

Candidates come from chosen paths. Each set is embedded into a fixed number of tokens, one
per min-hash function, so similar sets share about as many tokens as their similarity says.
In a run, every set picks those of its tokens whose hash, along with the path so far, falls
below ``1 / (threshold * tokens)``: sets that are similar enough share one picked token on
average. Sets with the same picks form a bucket. Buckets of more than ``BUCKET_LIMIT`` sets
are split again by further picks, up to ``MAX_DEPTH``; the others, and what is left large at
the end, are searched in full. A pair at the threshold is in a common bucket of a run with
a chance of 0.63 at depth one and 0.37 at depth three, so 20 runs find it with 0.9999;
higher similarity is found with higher chances. Within a bucket, sets are compared by the
share of equal min-hashes; those above a cautious bound (five standard errors below the
threshold) are tied together, one tie per set, not per pair.

Ties give groups of possible links, and every link found lies in one group. In a group the
full sets are compared exactly, through an inverted index. Large buckets and groups are cut
into chunks, and every pair of chunks is compared in a task of its own: nothing is capped,
and no task holds more than two chunks.

Null and blank texts have no shingles, no links, and are classes of their own. A text of one
to four words has one shingle of all of them; one without words, such as ``!!!``, has itself
as its shingle. Repeated rows are copies of each other. A null doc_id never is a class id
unless no copy has an id. Other columns are not read by ``similarity_classes``, and
``one_of_each`` keeps them.
"""
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import slices, staged, texts_of
from clickrev.llm.components import connected_components
from clickrev.llm.words import MIX_A, MIX_B, mixed, shingles
from clickrev.operators.names import own_names

WORDS = 5
THRESHOLD = 0.8
RUNS = 20
TOKENS = 128
BUCKET_LIMIT = 200
MAX_DEPTH = 3
#: Sets of a bucket, and shingles of a group, that one chunk holds.
BUCKET_CHUNK = 4096
GROUP_CHUNK = 4_000_000
#: Up to so many sets (about 60 bytes each) the list of texts to verify is broadcast; more
#: are joined by a shuffle.
BROADCAST_SETS = 1_000_000
#: Sketches are compared cautiously: five standard errors of the estimate.
SLACK = 5.0

_random = np.random.default_rng(7)
_FACTORS = _random.integers(0, 1 << 32, TOKENS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, TOKENS, dtype=np.uint32)
_SALTS = _random.integers(0, 1 << 64, TOKENS, dtype=np.uint64)


def min_hashes(tokens: np.ndarray) -> np.ndarray:
    """The embedding of a set: its smallest value under each hash function."""
    values = (tokens >> np.uint64(32)).astype(np.uint32)
    least = np.full(TOKENS, np.uint32(0xFFFFFFFF))
    for start in range(0, len(values), 256):
        table = values[start : start + 256, None] * _FACTORS + _SHIFTS
        least = np.minimum(least, table.min(axis=0))
    return least


def set_digest(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


_FEATURES_SCHEMA = (
    "doc_id BIGINT, text_hash BIGINT, node BIGINT, n INT, hashes BINARY, sketch BINARY"
)


def features(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row its set's digest ``node``, size, embedding and, for estimates, its low bytes.

    ``node`` is null without shingles.
    """

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nodes, sizes, hashes, sketches = [], [], [], []
            for text in texts_of(batch):
                tokens = shingles(text, words)
                sizes.append(len(tokens))
                nodes.append(set_digest(tokens) if len(tokens) else None)
                least = min_hashes(tokens)
                hashes.append(least.tobytes() if len(tokens) else None)
                sketches.append(least.astype(np.uint8).tobytes() if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(hashes, pa.binary()),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "text_hash", "node", "n", "hashes", "sketch"],
            )

    wanted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")
    )
    return wanted.mapInArrow(measure, _FEATURES_SCHEMA)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


def _picks(hashes: np.ndarray, paths: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and longer paths of the tokens that sets pick, given a path for each set."""
    token = (hashes.astype(np.uint64) + _SALTS) * MIX_A
    value = mixed(token ^ paths[:, None])
    limit = np.uint64(int((1 << 64) / max(1.0, threshold * TOKENS)))
    row, column = np.nonzero(value < limit)
    longer = mixed(value[row, column] * MIX_B + paths[row])
    return row, longer


def _first_picks(sets: DataFrame, runs_: int, threshold: float) -> DataFrame:
    """``path, node``: the buckets of depth one in every run."""

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes = _matrix(batch.column("hashes"))
            node = batch.column("node").to_numpy(zero_copy_only=False)
            for run in range(runs_):
                start = mixed(np.array([run + 1], np.uint64) * MIX_B)
                row, path = _picks(hashes, np.repeat(start, len(hashes)), threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(path.view(np.int64)), pa.array(node[row])], ["path", "node"]
                )

    return sets.select("node", "hashes").mapInArrow(pick, "path BIGINT, node BIGINT")


def _next_picks(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``path, node`` one level deeper."""

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            hashes = _matrix(batch.column("hashes"))
            paths = batch.column("path").to_numpy(zero_copy_only=False).view(np.uint64)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            row, path = _picks(hashes, paths, threshold)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path.view(np.int64)), pa.array(node[row])], ["path", "node"]
            )

    joined = rows.join(sets.select("node", "hashes"), "node")
    return joined.select("path", "node", "hashes").mapInArrow(pick, "path BIGINT, node BIGINT")


def _buckets(sets: DataFrame, runs_: int, threshold: float) -> DataFrame:
    """``path, chunks, node`` of all buckets of two or more sets that are searched in full."""
    spark = sets.sparkSession
    done = []
    rows = _first_picks(sets, runs_, threshold)
    for depth in range(1, MAX_DEPTH + 1):
        rows = staged(spark, rows.distinct(), "paths")
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sized = rows.join(sizes, "path")
        last = depth == MAX_DEPTH
        ready = sized if last else sized.filter(F.col("size") <= BUCKET_LIMIT)
        chunks = F.ceil(F.col("size") / BUCKET_CHUNK).cast("int").alias("chunks")
        done.append(ready.select("path", chunks, "node"))
        if not last:
            rows = _next_picks(sized.filter(F.col("size") > BUCKET_LIMIT), sets, threshold)
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def _chunk_pairs(df: DataFrame, key: str) -> DataFrame:
    """Repeat rows for every pair of chunks of their ``key``: ``_first``, ``_second``, ``_chunk``."""
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    return (
        df.withColumn("_chunk", chunk)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("_first", F.least("_chunk", "_other"))
        .withColumn("_second", F.greatest("_chunk", "_other"))
        .drop("_other", "chunks")
        .repartition(key, "_first", "_second")
        .sortWithinPartitions(key, "_first", "_second", "node")
    )


def _groups(
    batches: Iterable[pa.RecordBatch], keys: tuple[str, ...], names: tuple[str, ...]
) -> Iterator[list[np.ndarray]]:
    """For each key, in batches sorted by the keys, the columns ``names`` of its rows."""
    waiting: list[list[np.ndarray]] = []
    last = None

    def whole() -> list[np.ndarray]:
        return waiting[0] if len(waiting) == 1 else [np.concatenate(c) for c in zip(*waiting, strict=True)]

    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys], 1)
        columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True):
            key = values[start].tolist()
            if waiting and key != last:
                yield whole()
                waiting = []
            waiting.append([c[start:end] for c in columns])
            last = key
    if waiting:
        yield whole()


def possible_ties(sketch: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """For each set of a bucket the first set of its component of possible links.

    A search from set to set that looks at unvisited sets only.
    """
    n = len(sketch)
    # the share of equal 8-bit hashes, which other sets reach by chance with 1 / 256
    bound = threshold - SLACK * np.sqrt(threshold * (1 - threshold) / TOKENS)
    root = np.full(n, -1)
    unvisited = np.arange(n)
    while len(unvisited):
        first, unvisited = unvisited[0], unvisited[1:]
        root[first] = first
        waiting = [first]
        while waiting and len(unvisited):
            at = waiting.pop()
            small, large = np.minimum(sizes[at], sizes[unvisited]), np.maximum(sizes[at], sizes[unvisited])
            near = small >= threshold * large - 1e-9
            near[near] = (sketch[unvisited[near]] == sketch[at]).mean(axis=1) >= bound
            found = unvisited[near]
            root[found] = first
            waiting.extend(found.tolist())
            unvisited = unvisited[~near]
    return root


def _candidate_ties(buckets: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: sets of a bucket tied to the first of their component of possible links."""

    def tie(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for node, size, raw in _groups(batches, ("path", "_first", "_second"), ("node", "n", "sketch")):
            if len(node) < 2:
                continue
            sketch = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, TOKENS)
            root = possible_ties(sketch, size, threshold)
            tied = np.flatnonzero(root != np.arange(len(root)))
            a.append(node[tied])
            b.append(node[root[tied]])
            if len(a) > 5000:
                yield _pairs(a, b)
                a, b = [], []
        yield _pairs(a, b)

    def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
        empty = [np.empty(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([*a, *empty])), pa.array(np.concatenate([*b, *empty]))], ["a", "b"]
        )

    sketched = sets.select("node", "n", "sketch")
    rows = _chunk_pairs(buckets.join(sketched, "node"), "path")
    return rows.select("path", "_first", "_second", "node", "n", "sketch").mapInArrow(tie, "a BIGINT, b BIGINT")


def exact_links(sets: list[np.ndarray], threshold: float, cross: np.ndarray | None = None):
    """Rows and columns of all links between sets: pairs of Jaccard similarity at the threshold.

    Yields, per set, the linked sets. ``cross`` gives sides; only sets of other sides count.
    """
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, posted = tokens[order], owner[order]
    new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(tokens))
    place = np.empty(len(order), np.int64)
    place[order] = group
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    for k in range(len(sets)):
        mine = place[bounds[k] : bounds[k + 1]]
        low, many = starts[mine], ends[mine] - starts[mine]
        at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        shared = np.bincount(posted[at], minlength=len(sets))
        linked = shared >= threshold * (sizes + sizes[k] - shared) - 1e-9
        linked[k] = False
        if cross is not None:
            linked &= cross != cross[k]
        yield np.flatnonzero(linked)


def _verified(groups: DataFrame, docs: DataFrame, words: int, threshold: float) -> DataFrame:
    """``node, head, links`` per set and task: exact links within groups.

    ``groups`` has a row per set: node, root, chunks, copies and the document it is read from.
    ``head`` is the smallest set it is tied to by links seen in this task.
    """
    def tokenize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "root", "chunks", "copies"]
        for batch in slices(batches):
            sets = [shingles(text, words) for text in texts_of(batch)]
            # a text of the same hash but another set is not this one
            mine = [set_digest(s) == node for s, node in zip(sets, batch.column("node").to_pylist(), strict=True)]
            columns = [*(batch.column(c) for c in names), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "tokens"]).filter(pa.array(mine, pa.bool_()))

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        names = ("node", "tokens", "copies", "_chunk", "_first", "_second")
        for node, raw, copies, side, first, second in _groups(batches, ("root", "_first", "_second"), names):
            node, unique = np.unique(node, return_index=True)
            sets = [np.frombuffer(raw[k], np.uint64) for k in unique]
            copies, side = copies[unique], side[unique]
            two = first[0] != second[0]
            head = np.arange(len(node))  # union-find over the sets of this task

            def top(k: int) -> int:
                while head[k] != k:
                    head[k] = head[head[k]]
                    k = head[k]
                return k

            links = np.zeros(len(node), np.int64)
            for k, linked in enumerate(exact_links(sets, threshold, side if two else None)):
                links[k] = copies[linked].sum()
                for other in linked[linked > k].tolist():
                    a, b = top(k), top(other)
                    head[max(a, b)] = min(a, b)
            out += [(int(node[k]), int(node[top(k)]), int(links[k])) for k in range(len(node))]
            if len(out) > 20_000:
                yield _links(out)
                out = []
        if out:
            yield _links(out)

    def _links(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["node", "head", "links"])

    texts = docs.select(
        F.col("doc_id").cast("long").alias("of_id"), F.xxhash64("text").alias("of_hash"), "text"
    )
    # whole texts are not dealt out again if the list of those wanted is small
    few = groups.count() <= BROADCAST_SETS
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    wanted = texts.join(F.broadcast(groups) if few else groups, same).select("node", "root", "chunks", "copies", "text")
    tokenized = wanted.mapInArrow(tokenize, "node BIGINT, root BIGINT, chunks INT, copies BIGINT, tokens BINARY")
    rows = _chunk_pairs(tokenized, "root").select("node", "root", "_first", "_second", "_chunk", "copies", "tokens")
    return rows.mapInArrow(verify, "node BIGINT, head BIGINT, links BIGINT")


def _first_row() -> Column:
    """Orders rows by id, those without one last, then by the hash of the text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")


def similarity_classes(
    docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, runs_: int = RUNS
) -> DataFrame:
    """``doc_id, text_hash, class_id, n_links, class_node`` of every row of ``docs`` (doc_id, text).

    A class is a connected component of links, equal sets being linked; its id is the
    smallest doc_id in it. ``class_node`` stands for the class also where no row of it has an
    id; it is NULL for a row without shingles. ``n_links`` counts the other documents a document is linked to.
    """
    spark = docs.sparkSession
    every = staged(spark, features(docs, words), "features")
    counted = every.filter("node IS NOT NULL").groupBy("node").agg(
        F.min(_first_row()).alias("first"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")
    )
    distinct = staged(spark, counted.select("node", "first.doc_id", "first.text_hash", "copies", "n"), "sets")
    # the row of each set's smallest doc_id brings the embedding, once
    embedded = (
        every.filter("node IS NOT NULL")
        .select("node", "doc_id", "n", "hashes", "sketch")
        .join(
            distinct.select(F.col("node").alias("_node"), F.col("doc_id").alias("_doc_id")),
            (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")),
        )
        .select("node", "n", "hashes", "sketch")
        .dropDuplicates(["node"])
    )
    sets = staged(spark, embedded, "embedded")
    ties = _candidate_ties(_buckets(sets, runs_, threshold), sets, threshold)
    groups = connected_components(ties)
    classes = staged(spark, _classes(docs, distinct, groups, words, threshold), "classes")
    # rows without a set would meet in one task of a join
    alone = every.filter("node IS NULL").select(
        "doc_id",
        "text_hash",
        F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("long").alias("class_node"),
    )
    return (
        every.filter("node IS NOT NULL")
        .select("doc_id", "text_hash", "node")
        .join(classes, "node", "left")
        .select("doc_id", "text_hash", "class_id", "n_links", "class_node")
        .unionByName(alone)
    )


def _classes(
    docs: DataFrame, distinct: DataFrame, groups: DataFrame, words: int, threshold: float
) -> DataFrame:
    """``node, class_id, n_links, class_node`` of every set, from the groups of possible links."""
    spark = docs.sparkSession
    members = groups.join(distinct, "node")
    sizes = members.groupBy("root").agg(F.ceil(F.sum("n") / GROUP_CHUNK).cast("int").alias("chunks"))
    members = staged(spark, members.join(sizes, "root"), "members")
    verified = staged(spark, _verified(members, docs, words, threshold), "links")
    if members.filter("chunks > 1").isEmpty():
        heads = verified.select("node", "head")
    else:
        # tasks saw parts of a group: put their ties together
        tied = connected_components(verified.select(F.col("node").alias("a"), F.col("head").alias("b")))
        alone = verified.select("node").distinct().join(tied, "node", "left_anti")
        heads = tied.select("node", F.col("root").alias("head")).unionByName(
            alone.withColumn("head", F.col("node"))
        )
    ids = distinct.select("node", "doc_id", "copies")
    headed = heads.join(ids, "node")
    class_ids = headed.groupBy("head").agg(F.min("doc_id").alias("class_id"))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = heads.join(class_ids, "head").join(links, "node").select("node", "head", "class_id", "links")
    return ids.join(grouped, "node", "left").select(
        "node",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("head", "node").alias("class_node"),
    )


def one_of_each(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row of every class of ``docs``: that of the smallest id, then hash of the text.

    Rows without an id come last. Of rows that repeat id and text one stays, any of them. Rows
    without shingles, null and blank texts, all stay.
    """
    spark = docs.sparkSession
    _ = own_names(docs)
    classes = similarity_classes(docs, words, threshold).filter("class_node IS NOT NULL")
    keys = classes.groupBy("doc_id", "text_hash", "class_node").agg(F.count(F.lit(1)).alias("rows"))
    keys = staged(spark, keys, "class-rows")
    best = keys.groupBy(F.col("class_node").alias("best_of")).agg(F.min(_first_row()).alias("best"))
    is_best = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    marked = keys.join(best, F.col("class_node") == F.col("best_of")).select(
        F.col("doc_id").alias(_("id")), F.col("text_hash").alias(_("hash")), "rows", is_best.alias("best")
    )
    marked = staged(spark, marked, "class-best")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(_("id"))) & (F.xxhash64("text") == F.col(_("hash")))

    kept = docs.join(marked.filter("NOT best").select(_("id"), _("hash")), same, "left_anti")
    repeated = marked.filter("best AND rows > 1").select(_("id"), _("hash"))
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated, same, "left_semi").withColumn(_("hash"), F.xxhash64("text"))
    once = again.dropDuplicates(["doc_id", _("hash")]).drop(_("hash"))
    return kept.join(repeated, same, "left_anti").unionByName(once)


def op2_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity class and number of links of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return similarity_classes(docs).select("doc_id", "class_id", "n_links")
