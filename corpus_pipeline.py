"""From raw documents to a training mix: five stages, each written and read again.

Defined cases: a null or blank text, like any of fewer than 50 words, goes in
the first stage; without labels (or with too few) only the base rules judge
there; rows that agree in id and text are one document, which the second stage
keeps once; rows without an id are kept by it, as no component has their name;
without a benchmark nothing is contaminated; a null source is a source of its
own; null languages are a stratum of their own; an empty table of documents
gives an empty mix. All columns of the table are carried along; the mix adds
`copy`, or `copy_` if the table has a column of that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierhouse.llm import decontaminate, minhash, mixing, pii, quality_rules
from tierhouse.llm.common import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs keep."""
    return quality_rules.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8. Texts that share an id are documents of their own."""
    return minhash.one_of_each(docs, width=5, percent=80, one_per_id=False)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words with the benchmark."""
    return decontaminate.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with the number of the copy."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("mixing", mix),
]

#: Cutoffs, components and draws are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table of documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
