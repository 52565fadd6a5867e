"""The registered queries of the text operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.llm import licenses, periodic, phrases, pii, substrings, toxicity
from gaugework.llm.common import documents, stored
from gaugework.llm.mixing import mix, mix_sql
from gaugework.llm.multiset import fingerprints
from gaugework.llm.packing import pack, token_pieces
from gaugework.llm.quality_rules import COUNTS, LENGTHS, repetition
from gaugework.llm.repair import block_starts, round_trip
from gaugework.llm.simhash import near_duplicates
from gaugework.llm.suffix import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(plan: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[plan.__name__] = plan
    return plan


@query
def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = repetition(documents(spark, sf_dir).select("doc_id", "text"))
    names = [*COUNTS, *(f"dup_{n}gram_chars" for n in LENGTHS), "base_failed", "kept"]
    return measured.select("doc_id", *(F.col(f"quality.{name}").alias(name) for name in names))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), shingle=3, most=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    base = found.select("doc_id", *(pii.count_of(k).alias(f"n_{k}") for k in pii.BASE), pii.named("base_spans").alias("base"), pii.named("spans").alias("spans"))
    return base.select("doc_id", *(f"n_{k}" for k in pii.BASE), F.sha2("base", 256).alias("base_sha256"), "spans")


# Target weights of the mix: four domains of sources, then languages, then sources alike.
DOMAIN_WEIGHTS = {"domain0": 4.0, "domain1": 3.0, "domain2": 2.0, "domain3": 1.0}
LANGUAGE_WEIGHTS = {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}
MIX = {"share": 0.5, "epochs": 2.0, "seed": 17}


def with_domain(docs: DataFrame, name: str = "domain") -> DataFrame:
    """Sources are dealt to the four domains by the number in their name; without one to domain0."""
    number = F.coalesce(F.try_to_number(F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,9})$", 1), F.lit("999999999")), F.lit(0))
    return docs.withColumn(name, F.concat(F.lit("domain"), (number % 4).cast("int").cast("string")))


def weight_tables(spark: SparkSession, domain: str = "domain") -> dict[str, DataFrame]:
    return {
        domain: spark.createDataFrame(list(DOMAIN_WEIGHTS.items()), f"{domain} string, weight double"),
        "lang": spark.createDataFrame(list(LANGUAGE_WEIGHTS.items()), "lang string, weight double"),
    }


@query
def op8_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    levels = ["domain", "lang", "source"]
    mixed = mix(docs, levels, MIX["share"], weight_tables(spark), MIX["epochs"], MIX["seed"])
    return mixed.select("doc_id", *levels, "tokens", "epochs")


ORACLES["op8_hierarchical_mix"] = mix_sql(
    """SELECT doc_id, lang, source, 'domain' || (coalesce(try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT), 0) % 4) AS domain,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents""",
    ["domain", "lang", "source"],
    {"domain": DOMAIN_WEIGHTS, "lang": LANGUAGE_WEIGHTS},
    MIX["share"],
    MIX["epochs"],
    MIX["seed"],
)


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query
def op3_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    pieces = token_pieces(docs, tokenizer_path(), capacity=2048, end_id=0)
    pieces = stored(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(pieces, pieces.count(), ["doc_id", "piece", "start", "ids_crc32"], capacity=2048)


@query
def op4_re_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, docs = round_trip(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path(), end_id=2)
    docs = docs.select("doc_id", "part", "block", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    placed = docs.join(block_starts(files), ["part", "block"])
    return placed.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


@query
def op5_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir).select("doc_id", "text"))


@query
def op7_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    scored = docs.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), toxicity.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.DECISION).cast("int"))


@query
def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_canonical_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir).select("doc_id", "text"), licenses.known_texts(spark))


ORACLES["op2_canonical_digest"] = licenses.scan_sql()


@query
def op11_maximal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    found = periodic.periodic_runs(docs).select("doc_id", "periodic.*")
    best = found.withColumn("best", periodic.strongest("runs"))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_later_repeats(documents(spark, sf_dir).select("doc_id", "text"), length=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op12_seed_extend"] = substrings.later_repeats_sql()


@query
def op13_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir).select("text", "lang"))


ORACLES["op13_prefix_free"] = phrases.collocations_sql()
