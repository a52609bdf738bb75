"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written and read again before the next one. Rows pass or fall; but for the
last, a stage returns the columns it was given. Rows with a null doc_id or
text are handled as each operator says; extra columns travel along untouched.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leptide.llm import bpe, decontaminate, line_dedup, near_dup, rule_classifier
from leptide.llm.common import saved
from leptide.llm.queries import byte_bpe, quality_model, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learned from the labels, scores 0.5 or more."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(rule_classifier.score(model, F.col("text")) >= 0.5)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks; a document of which nothing is left goes. n_chars follows the text."""
    out = line_dedup.rebuild(docs, line_dedup.removed_chunks(docs)).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.col("n_removed") > 0
    new = {"text": F.col("text"), "n_chars": F.when(changed, F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[new[c].alias(c) if new.get(c) is not None else F.col("row").getField(c).alias(c) for c in docs.columns])


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group linked by five-word shingles at 0.8 or more; rows of one id go or stay by their texts."""
    found = near_dup.near_duplicates(docs, width=5, percent=80)
    gone = found.where("not kept and doc_id is not null").select(F.col("doc_id").alias("gone_id"), "text_key").distinct()
    return docs.join(gone, (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["text_key"]), "left_anti")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("row").alias("found_row")).distinct()
    return docs.join(found, F.xxhash64(docs["doc_id"], docs["text"]) == found["found_row"], "left_anti")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of ids and of the text decoded from them."""
    return bpe.encode_documents(docs, byte_bpe(), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_dup_stage),
    ("decontamination", benchmark_stage),
    ("token ids", token_stage),
]

#: Trees, MinHash and merges have no SQL twin; the operators are held against plain versions in their own tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
