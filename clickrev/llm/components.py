"""Connected components of a graph, by alternating large-star and small-star steps."""
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.llm.arrow import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node in ``edges`` (a, b: BIGINT); the root is the smallest node.

    Each round writes its edges as a table, so a lost executor costs a re-read. Rounds go on
    until the edges stay the same, which then form one star per component. A node with very
    many edges is a skewed join key, which adaptive execution splits; minima are
    pre-aggregated.
    """
    spark = edges.sparkSession
    current = staged(spark, edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        current = _star(spark, both, larger=True)
        down = current.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        current = _star(spark, down, larger=False)
        after = _state(current)
        if after == before:
            break
        before = after
    children = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return children.unionByName(children.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _star(spark: SparkSession, edges: DataFrame, larger: bool) -> DataFrame:
    """Tie each node's neighbours (the larger ones, or all and itself) to its smallest neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(F.col("a").alias("_a"), F.least("a", "least").alias("least"))
    joined = edges.join(least, F.col("a") == F.col("_a"))
    if larger:
        tied = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        tied = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("_a").alias("a"), F.col("least").alias("b"))
        )
    return staged(spark, tied.filter("a <> b").distinct(), "edges")
