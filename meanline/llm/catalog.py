"""Queries over the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meanline.llm import codebooks, collocations, html, licences, lines, mixing, near, neighbours, passages, pieces_bpe, quality, sharding, warc
from meanline.sources.storage import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


#: The vocabulary of the token queries; a path, so that other models can be put in its place.
MODEL = "piece_bpe_32k.model"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL when SQL can express it."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


@query("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, directory: str) -> DataFrame:
    """Visible text of all pages."""
    pages = table(spark, directory, "pages").select("page_id", "html")
    return html.extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))


@query("op2_licence_scan", licences.scan_sql())
def op2_licence_scan(spark: SparkSession, directory: str) -> DataFrame:
    """Licence phrases and notices of all documents."""
    return licences.scan(table(spark, directory, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query("op3_suffix_array_dedup")
def op3_suffix_array_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """What is left of every document without the 100-byte strings that start earlier in the corpus."""
    return passages.summarize(table(spark, directory, "documents"))


WARC_SQL = """
with p as (select page_id, coalesce(html, '') as html, encode(coalesce(html, '')) as payload from pages),
d as (select page_id, octet_length(payload)::bigint as payload_bytes, sha1(payload) as payload_digest,
  max(page_id) over (partition by html) as holder from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes < 1000 or page_id is not distinct from holder then 'response' else 'revisit' end as record_type,
  case when payload_bytes >= 1000 and page_id is distinct from holder then holder end as refers_to
from d
"""


@query("op4_warc_seekable_zstd", WARC_SQL)
def op4_warc_seekable_zstd(spark: SparkSession, directory: str) -> DataFrame:
    """All pages written as WARC records into seekable bundles and read back."""
    folder = new_path(spark, "warc")
    warc.write_archive(table(spark, directory, "pages"), folder)
    return warc.read_archive(spark, folder)


@query("op5_minhash_near_dedup")
def op5_minhash_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """Near-duplicate groups of all documents on three-word shingles at 85 %."""
    return near.near_duplicates(table(spark, directory, "documents"), shingle_words=3, percent=85)


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, directory: str) -> DataFrame:
    """Digests of every document's token ids and of the text they decode to."""
    return pieces_bpe.digests(table(spark, directory, "documents"), model_path())


@query("op7_source_mixing", mixing.MIX_SQL)
def op7_source_mixing(spark: SparkSession, directory: str) -> DataFrame:
    """All documents mixed so that sources weigh 1, 2, 3 and so on in turn."""
    return mixing.mix(table(spark, directory, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    """Counts and verdict of every document under a decision list learned from the labels."""
    documents = table(spark, directory, "documents").select("doc_id", "text")
    rules = quality.fit(documents, table(spark, directory, "labels"))
    return quality.judge(documents, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept"
    )


@query("op9_cross_polytope_neighbours")
def op9_cross_polytope_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    """The ten nearest rows found for every hundredth vector."""
    return neighbours.nearest(table(spark, directory, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op10_best_fit_sharding")
def op10_best_fit_sharding(spark: SparkSession, directory: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, equal texts together."""
    return sharding.assign(table(spark, directory, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op11_bloom_line_dedup", lines.LINES_SQL)
def op11_bloom_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """All documents without the lines that stand in ten or more of them."""
    left = lines.drop_repeated_lines(table(spark, directory, "documents"), min_documents=10, keep_first=False)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op12_rollup_collocations", collocations.COLLOCATIONS_SQL)
def op12_rollup_collocations(spark: SparkSession, directory: str) -> DataFrame:
    """The strongest phrases of two and three words of each language."""
    return collocations.collocations(table(spark, directory, "documents"))


@query("op13_orchard_codes", codebooks.CODES_SQL)
def op13_orchard_codes(spark: SparkSession, directory: str) -> DataFrame:
    """Codes of all vectors in four parts of 256 entries, their errors and the codebooks' digest."""
    return codebooks.codes_with_totals(table(spark, directory, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )
