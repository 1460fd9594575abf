"""The corpus pipeline: quality rules, near-duplicates, repeated passages, source mixing, token ids.

Every stage takes (spark, docs, sf_dir), works on all rows the stage before kept, and returns a
DataFrame; ``run`` writes each stage's rows to the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meanline.llm import mixing, near, passages, pieces_bpe, quality
from meanline.llm.catalog import model_path
from meanline.sources.storage import shared_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from the labels."""
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, rules).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked on five-word shingles at 80 %."""
    kept = near.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    return named.unionByName(docs.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages of 100 bytes and more that stand earlier in the corpus."""
    return passages.remove_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the sources weigh 1, 2, 3 and so on in turn."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and digests of the token ids of every row and of the text they decode to."""
    return pieces_bpe.digests(docs, model_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]
#: The learned rules and the signatures are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
