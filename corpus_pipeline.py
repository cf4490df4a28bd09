"""The corpus pipeline: quality rules, dedup, near dedup, mixing and tokens.

``run`` applies STAGES to the documents; each stage's rows are written to the shared folder
and read again by the next one, so no stage is computed twice and a lost executor costs one
stage's tasks at most. All but the last return the columns of ``documents``, whatever columns
come beside those. What a stage writes for itself, and its input, are deleted once its rows are
there.

Cases. Null and empty texts have no words, so the quality rules reject them. Of equal texts with
the same id one stays, of texts with different ids the one with the smallest. Rows without an id
come last where ids decide, and are near copies of nothing. A null source is no host, and in the
mix a source of its own. An empty table goes through all stages. The stages on their own handle
what their operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxmill.llm import byte_bpe, exact_dedup, host_rules, ngram_join, pareto_mix, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the text's or the host's rules reject go."""
    return host_rules.keep_good(spark, docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return exact_dedup.keep_first(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by similar shingles the one with the smallest id stays."""
    return ngram_join.keep_one(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return pareto_mix.repeat_rows(spark, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to."""
    return byte_bpe.digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("tokens", tokens),
]
#: SQL has no byte-level BPE; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        with scratch.temporary(spark):
            docs = scratch.save(stage(spark, docs, sf_dir), name, passing=False)
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
