"""Documents to a training mixture: quality rules, near-duplicates, decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of the
documents; the last adds `copy`. Every stage is written and read again, so a lost executor costs a stage at most.
"""

from pyspark.sql import DataFrame, SparkSession

from sparklogs.llm import decontaminate, mixing, order_minhash, pii, quality
from sparklogs.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the cutoffs are fitted on the labelled ones."""
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return order_minhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes surrogates."""
    return pii.pseudonymise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture takes them."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal_data), ("mixture", mixture),
]
#: Near-duplicates and surrogates cannot be expressed in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
