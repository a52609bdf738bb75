"""One query for each operator, over whole tables, with the digest columns their contracts name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, decontaminate, line_dedup, merkle, near_dup, perplexity, pii, rule_classifier, sharding, spotsigs, token_count, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 40
#: Verdict and rule (host, path), as given by the contract of op2.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `bytes`: groups of equal texts, minimax sizes."""
    out = sharding.minimax_shards(table(spark, sf_dir, "documents"), shards=SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op2_url_rules")
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages judged by the fixed rules, else by rules mined from the labels of equal id (bad: quality 0 or toxic)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    labelled = pages.join(labels, "page_id").select("url", "bad")
    return url_filter.judge_urls(pages, labelled, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "n_rules", F.round("confidence", 6).alias("confidence"))


@query("op3_spaced_seeds")
def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item: a row for each document and item."""
    out = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", F.col("score").cast("long").alias("score"), F.col("matched").cast("long").alias("matched"))


@query("op6_line_chunks", line_dedup.SQL)
def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the chunks of lines that occurred before."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.sanitise(table(spark, sf_dir, "documents"), with_text=False, everywhere=True)
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(pii.span_list(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return out.select("doc_id", *[n(k) for k in pii.KINDS], digest, pii.span_list(F.col("spans")).alias("spans"))


@query("op4_minhash_near_dup", near_dup.SQL)
def op4_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of two-word shingle sets with a similarity of 0.8 or more."""
    out = near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_perplexity_rules")
def op5_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.perplexity_rules(table(spark, sf_dir, "documents"))


def held_out(doc_id) -> object:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame) -> rule_classifier.RuleModel:
    """Rules learned from the labels outside the held-out fold."""
    learned = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    return rule_classifier.fit_rules(docs, learned)


@query("op7_quality_rules_ensemble")
def op7_quality_rules_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return rule_classifier.score_documents(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def byte_bpe() -> list[bytes]:
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), byte_bpe(), public_tokenizers.PATTERN, keep_ids=False)


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query("op13_merkle_manifest", merkle.SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that a tampered copy of it folds to."""
    docs = table(spark, sf_dir, "documents")
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.when(picked, F.translate("text", upper, lower)).otherwise(F.col("text"))
    cells = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    rows = docs.select("doc_id", "source", merkle.leaf(*cells, F.col("text")).alias("leaf"), merkle.leaf(*cells, text).alias("seen"))
    rows = rows.withColumn("seen", F.when(F.col("seen") != F.col("leaf"), F.col("seen")))
    out = merkle.manifest(rows, group="source", order="doc_id", leaf="leaf", carry=["seen"])
    out = out.withColumn("folded_root", F.when(F.col("seen").isNull(), merkle.fold(F.col("leaf"), F.col("steps"))).otherwise(merkle.fold(F.col("seen"), F.col("steps"))))
    return out.select("doc_id", "leaf", "subroot", "root", merkle.digest(merkle.proof(F.col("steps"))).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op11_collocations", collocations.SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_spotsigs", spotsigs.SQL)
def op12_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next one are."""
    out = spotsigs.with_edited(table(spark, sf_dir, "documents"))
    sig, edited = F.col("sig"), F.col("edited_sig")
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), spotsigs.fingerprint(sig).alias("fingerprint"),
        spotsigs.fingerprint(edited).alias("edited_fingerprint"), spotsigs.likeness(sig, edited).alias("near_edited"), spotsigs.likeness(sig, F.col("next_sig")).alias("near_next"),
    )
