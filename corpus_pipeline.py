"""A corpus from raw documents to packed sequences: rules, classifier, near copies, packing.

``run`` applies the stages to the documents of a folder. Each stage takes the rows that the one before it
kept, written as Parquet and read again, and all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepanel.llm import best_fit, jaccard_join, line_crf, quality_rules
from tradepanel.llm.common import read_file, sieved
from tradepanel.session import materialise


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    judged = quality_rules.quality_rules(docs)
    return judged.where("kept").select(*docs.columns)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of documents that are still there, takes as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = line_crf.score(docs, line_crf.train(docs, labels))
    return scored.where("score >= 0.5").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of similar ones; a repeated id stays once in each class.

    Documents without words, and without id, are in no class and stay. Rows of one id with different texts are
    told apart by their text. Rows that go, or whose id is repeated in its class, meet the documents that a sieve of
    their keys lets through; no other text is shuffled.
    """
    on = ["doc_id", "_key"]
    classes = materialise(jaccard_join.text_classes(docs).withColumnRenamed("key", "_key"), "classes").where("doc_id is not null")
    gone = classes.where("doc_id <> component_id").select(on)
    texts = classes.where("doc_id = component_id").groupBy("doc_id", "class", "_key").agg(F.count(F.lit(1)).alias("n"))
    again = texts.groupBy(F.col("doc_id").alias("_id"), F.col("class").alias("_class")).agg(F.sum("n").alias("n"), F.min("_key").alias("_first"))
    again = again.where("n > 1")
    repeated = texts.join(again, (F.col("doc_id") == F.col("_id")) & F.col("class").eqNullSafe(F.col("_class")), "left_semi").select(on)
    out = materialise(gone.union(repeated).distinct(), "gone")
    first = materialise(again.select(F.col("_id").alias("doc_id"), F.col("_first").alias("_key")), "first")
    clear, met = sieved(docs.withColumn("_key", jaccard_join.text_key(F.col("doc_id"), F.col("text"))), out, "_key")
    rest = clear.union(met.join(out.hint("merge"), on, "left_anti").select(*clear.columns))
    once = met.join(first, on, "left_semi").dropDuplicates(on)
    return rest.select(*docs.columns).union(once.select(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document stands in the packed sequences, in tokens."""
    return best_fit.pack_texts(docs, read_file(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN)


STAGES = [("quality rules", rules), ("quality classifier", classifier), ("n-gram Jaccard join", near_copies), ("best-fit packing", packing)]

# The classifier is trained and the packing is a greedy search, which SQL cannot state; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
