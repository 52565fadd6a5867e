"""The text pipeline: each stage reads what the stage before it has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.llm import pii
from gaugework.llm.common import stored
from gaugework.llm.mixing import mix
from gaugework.llm.packing import pack, token_pieces
from gaugework.llm.quality_rules import keep_good
from gaugework.llm.queries import tokenizer_path, weight_tables, with_domain
from gaugework.llm.simhash import one_of_each
from gaugework.session import scratch_path, short_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Share of the tokens that the mix takes; each document at most once.
SHARE, EPOCHS, SEED = 0.8, 1.0, 17
CAPACITY = 2048
#: Words whose ids a worker remembers, and bytes of texts that it encodes at once. Workers serve all stages and keep what they
#: have, so in the pipeline they keep less than the operator alone does.
REMEMBERED, SLICE_BYTES = 150_000, 1 << 18


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts go; repeated rows are judged alike and all stay."""
    short_batches(spark)
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints: three-word shingles, two bits.

    Null and empty texts have one fingerprint and are a group. Of rows with the smallest id one stays, of the smallest text
    hash. A null id is the smallest only in a group without others.
    """
    short_batches(spark)
    return one_of_each(docs, shingle=3, most=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with <kind> in place of each span of personal data. Null texts stay null; repeated rows change alike."""
    return pii.redact(docs, pii.fit(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that meet the target weights of domains, languages and sources within SHARE of all words.

    A null language or source is a branch of its own; a source without a number belongs to domain0. Texts without words
    weigh nothing. Repeated rows are documents of their own; ties in the seeded order are broken by all that is known of them.
    """
    domain = "__domain"
    mixed = mix(with_domain(docs, domain), [domain, "lang", "source"], SHARE, weight_tables(spark, domain), EPOCHS, SEED)
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document: its tokens' digest and its place in a sequence of CAPACITY tokens.

    Null and empty texts are the end token alone; repeated rows are packed each; a null id stays null.
    """
    short_batches(spark)
    pieces = token_pieces(docs, tokenizer_path(), CAPACITY, 0, remembered=REMEMBERED, slice_bytes=SLICE_BYTES)
    pieces = stored(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(pieces, pieces.count(), ["doc_id", "piece", "start", "ids_crc32"], CAPACITY)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: Fingerprints, span models and token ids are beyond SQL; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
