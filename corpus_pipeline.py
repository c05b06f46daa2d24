"""From raw documents to packed training sequences, stage by stage.

``run`` applies the stages to ``documents``; each writes its result as a table in the shared
folder, and the next one reads it. All but the last keep the columns of ``documents``.

1. language: documents without a letter, or without a language more likely than all others
   together, go.
2. near duplicates: one document of each similarity class stays, that of the smallest id.
3. decontamination: documents with a benchmark item go.
4. personal data: spans are replaced by their kind.
5. packing: documents become pieces of sequences of 1,024 tokens.
"""
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickrev.llm.decontaminate import decontaminate
from clickrev.llm.jaccard_join import one_of_each
from clickrev.llm.language import UNDETERMINED, held_out, identify, train
from clickrev.llm.packing import pack_documents
from clickrev.llm.pii import redact
from clickrev.operators.names import own_names
from clickrev.sources.files import join_path
from clickrev.sources.workspace import discard, scratch, workspace

#: A language must be more likely than all others together.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language; learned from the documents not held out."""
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    _ = own_names(docs)
    known = (F.col(_("lang")) != UNDETERMINED) & (F.col(_("score")) >= LEAST_SCORE)
    return identify(docs, model, into=(_("lang"), _("score"))).filter(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each similarity class."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return pack_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL can express none of the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``.

    A stage's own intermediate tables, and the table it read, go as soon as its result is
    written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    read: str | None = None
    for name, stage in STAGES:
        folder = workspace(spark, f"pipeline-{name}")
        table = join_path(folder, "table")
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(table)
        if read:
            discard(spark, read)
        docs, read = spark.read.schema(result.schema).parquet(table), folder
    return docs
