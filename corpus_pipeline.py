"""The corpus pipeline: five stages over ``documents``, each by one of the operators in ``ledgerline.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes
every stage's result as Parquet to the shared folder and reads it as the next
one's documents, so a lost executor costs a task, not a stage.

1. quality rules       documents that the line-first rules reject go, failing lines of the others too
2. n-gram join         one document of each group of linked documents stays
3. decontamination     documents that hold a benchmark item go
4. secrets             secrets found are replaced by a mark in the text, where they stand
5. packing             the pieces of what is left, a sequence each

Defined results: null or empty texts go in stage 1 (too few words); null doc_id:
a document like others, that stays only where its group has no id; of rows
equal in doc_id and text one stays; very long texts go through whole; an empty
table stays empty through all stages; further columns go along to stage 4,
whatever their names; null lang or source: kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, ngram_join, packing, quality, secrets
from ledgerline.llm.common import joined, stored, table

#: The columns of documents, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document's hash while a stage looks at it; no column of documents has this name.
ROW = "__row"


def hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW, F.xxhash64(F.col("doc_id").cast("long"), "text"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their failing lines."""
    return quality.keep(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id (ties: of one text hash), once."""
    found = ngram_join.join_components(docs)
    # Documents without words are linked with nothing: each stays.
    first = found.where("root is not null").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    )
    keep = first.select(F.col("first.row").alias("row")).union(found.where("root is null").select("row")).distinct()
    return joined(hashed(docs), keep.withColumnRenamed("row", ROW), [ROW], "left_semi").dropDuplicates([ROW]).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    leaks = decontaminate.find(docs, table(spark, sf_dir, "benchmark")).select("row").distinct()
    return joined(hashed(docs), leaks.withColumnRenamed("row", ROW), [ROW], "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with secrets masked; n_chars follows the text where it changed."""
    return secrets.masked(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digests(docs)


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", mask_secrets),
    ("packing", pack_sequences),
]

#: SQL can't express the forest of the secret scan nor the tokenizer; tests hold run() against the stages in Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
