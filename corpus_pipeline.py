"""A corpus for training, in five stages over the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuemill.llm import jaccard, linededup, mixing, packing, quality
from cuemill.llm.common import bounded_join, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labelled rows, doesn't reject."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).filter("predicted = 1").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of 50 words or more that an earlier document has; wholly repeated documents go."""
    kept = linededup.dedup_lines(docs)
    kept = kept.filter(~((F.col("n_removed") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: five-word shingles, 0.8 or more. Of a group that with the smallest id
    (null last) stays; among rows with that id, repeated rows too, a hash of the row decides. Rows go by a key of their
    own, so rows with null or shared ids count each for itself. Texts without words are in no group."""
    keyed = staged(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    found = jaccard.near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text"), n=5, percent=80)
    copies = staged(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_row"), "component_id"), "near-copies")
    members = staged(copies.unionByName(copies.select(F.col("component_id").alias("_row"), "component_id").distinct()), "near-members")
    order = keyed.select("_row", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64(*COLUMNS).alias("h"), "_row").alias("order"))
    first = bounded_join(order, members, ["_row"], "inner").groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first._row").alias("_row"))
    gone = staged(members.select("_row").join(first, "_row", "left_anti"), "near-gone")
    return bounded_join(keyed, gone, ["_row"], "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix of sources takes them."""
    return mixing.repeat(mixing.mix(docs)).select(*COLUMNS)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in bins."""
    return packing.pack(docs)


STAGES = [("quality", good_quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mix_sources), ("packing", pack_bins)]

#: The classifier and the hashes of the later stages aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
