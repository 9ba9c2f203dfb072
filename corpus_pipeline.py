"""From raw documents to token ids: the operators of ``starloom.llm`` in five stages.

Every stage takes ``(spark, docs, sf_dir)``, works on all that the one before
kept, and returns the columns of ``docs``; the last adds ``ids``. Stages are
stored in the shared folder, so that a lost executor costs no more than a stage.

NULL and empty texts end in the first stage, which rejects texts of under fifty
words. Rows without a doc_id are not linked or dropped as near-duplicates or
leaks; rows that repeat a doc_id share its fate. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import bpe, decontaminate, near_dedup, quality_rules, secrets
from starloom.llm.registry import table
from starloom.session import drop_intermediates, intermediates, reliable_checkpoint


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or look like the corpus' junk go."""
    return quality_rules.accepted(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; all documents stay."""
    return secrets.masked(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text are added."""
    return bpe.encode(docs, bpe.public_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", dedup),
    ("decontamination", decontaminated),
    ("secret_scan", without_secrets),
    ("bpe", tokens),
]

#: Likelihood ratios of hashed n-grams and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table ``documents`` of ``sf_dir``.

    Once a stage is stored, what it wrote on the way and the stage before go; the
    last stage's table stays. No other thread may store tables meanwhile.
    """
    docs, start = table(spark, sf_dir, "documents"), intermediates()
    for _, stage in STAGES:
        docs = reliable_checkpoint(stage(spark, docs, sf_dir))
        drop_intermediates(spark, since=start, until=intermediates() - 1)
    return docs
