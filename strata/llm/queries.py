"""The corpus operators over the supplied tables, each on whole tables and texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.byte_bpe import encode_documents
from strata.llm.decontaminate import find_leaks
from strata.llm.divergence import divergence
from strata.llm.infill import infill, restore
from strata.llm.minhash import NearDuplicates, near_duplicates
from strata.llm.packing import pack_documents
from strata.llm.pii import find_pii, fit_on
from strata.llm.quality import COUNTS, judge_quality
from strata.llm.secrets import scan_secrets
from strata.llm.sharding import shard_rows
from strata.llm.suffixes import find_repeats
from strata.llm.token_files import token_files
from strata.llm.urls import UrlRule, judge_urls

SHARDS = 40
END_ID = 2

# Rules by host and path with their verdicts.
HOST_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
# Words that mark hosts and paths nobody wants to train on, and the patterns in
# which each of them is looked for.
UNWANTED_WORDS = (
    "ads", "adserver", "adult", "affiliate", "banner", "bets", "betting", "bingo", "bonus", "casino",
    "cialis", "click", "coupon", "dating", "doubleclick", "escort", "forex", "gambling", "hookup", "jackpot",
    "lottery", "nude", "payday", "pills", "poker", "popup", "porn", "promo", "replica", "roulette",
    "sexcam", "slots", "spam", "sponsor", "track", "tracker", "viagra", "webcam", "xxx", "warez",
)
UNWANTED_PATTERNS = (
    "||{0}.", "||{0}-", "^{0}^", "^{0}s^", "-{0}-*/", "/{0}_", "/{0}/*.html", "_{0}.", "^free-{0}*^online^",
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot; shard sizes differ by one row at most."""
    text = F.coalesce("text", F.lit(""))
    sized = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    sharded = shard_rows(sized, SHARDS)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def vocabulary(name: str) -> str:
    """Where the installed vocabulary files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 1024 tokens."""
    docs = read(spark, sf_dir, "documents")
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), END_ID, 1024)


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents at a shingle similarity of 0.85 and more."""
    found = near_duplicates(read(spark, sf_dir, "documents"), NearDuplicates(numerator=85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def url_rules() -> list[UrlRule]:
    """The host rules ahead of some hundred patterns, which go by themselves."""
    named = [UrlRule(name, f"||{name}", verdict, rank=1) for name, verdict in HOST_RULES]
    patterns = [form.format(word) for word in UNWANTED_WORDS for form in UNWANTED_PATTERNS]
    return named + [UrlRule(pattern, pattern) for pattern in patterns]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; ``rule`` names host rules only, ``pattern`` any rule."""
    judged = judge_urls(read(spark, sf_dir, "pages"), url_rules())
    rule = F.when(F.col("rule").isin([name for name, _ in HOST_RULES]), F.col("rule"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), "verdict", "pattern")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every string that could be a secret, with the forest's score and verdict."""
    found = scan_secrets(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "start",
        (F.col("start") + F.length("candidate")).alias("end"),
        F.sha2("candidate", 256).alias("candidate_sha256"),
        F.round("score", 6).alias("score"),
        "is_secret",
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-frequency verdict on every document."""
    judged = judge_quality(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "n_removed_words")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that several documents hold."""
    return find_repeats(read(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts and digest, and all spans."""
    docs = read(spark, sf_dir, "documents")
    found = docs.select("doc_id", find_pii(F.col("text"), fit_on(docs)).alias("found"))
    return found.select("doc_id", "found.*").drop("masked")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the binary token files."""
    docs = read(spark, sf_dir, "documents")
    return token_files(docs, vocabulary("word_bpe_49k.json"), END_ID)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document."""
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of a language, and terms that a source has too much of."""
    return divergence(read(spark, sf_dir, "documents"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in fill-in-middle form, and what is rebuilt from that."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    made = docs.select("doc_id", infill(F.col("doc_id"), F.col("text")).alias("made")).select("doc_id", "made.*")
    back = restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by byte pairs, and decoded from the ids."""
    import public_tokenizers

    files = (vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_documents(docs, *files, decoded="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_packing": op2_packing,
        "op3_minhash_dedup": op3_minhash_dedup,
        "op4_url_filters": op4_url_filters,
        "op5_secret_scan": op5_secret_scan,
        "op6_quality_rules": op6_quality_rules,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_pii": op8_pii,
        "op9_token_files": op9_token_files,
        "op10_decontamination": op10_decontamination,
        "op11_divergence": op11_divergence,
        "op12_infill": op12_infill,
        "op13_byte_bpe": op13_byte_bpe,
    }


def oracle_sql() -> dict[str, str]:
    from strata.llm.oracles import ORACLES

    return dict(ORACLES)
