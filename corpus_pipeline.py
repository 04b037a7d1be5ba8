"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread.

Rows without a doc_id can't be told apart: where they are not rejected as toxic, they stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladespark.llm import jaccard, packing, pii, toxicity
from cladespark.storage import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold; the machine is fitted on the labelled documents."""
    machine = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(F.struct("*").alias("row"), "text")  # whatever its columns are called
    return toxicity.score(rows, machine, ["row"]).filter("predicted = 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that five-word shingles link at 0.8 or more, the one with the smallest doc_id."""
    found = jaccard.groups(docs, words=5, percent=80)
    kept = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).checkpoint()
    named = docs.join(jaccard.checked_broadcast(kept.select("doc_id")), "doc_id", "left_semi")
    if kept.filter("times > 1").limit(1).count():  # a doc_id that is there more than once
        named = named.dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.filter("doc_id is null")).select(*docs.columns)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data and secrets."""
    replaced = pii.replace(docs.select(F.struct("*").alias("row"), "text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.size("entities") > 0, length).otherwise(F.col("row.n_chars"))
    return replaced.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("n-gram jaccard join", drop_near_copies), ("pii", replace_pii), ("best-fit packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    with scratch(spark) as tables:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES[:-1]:
            docs = tables.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        return STAGES[-1][1](spark, docs, sf_dir)
