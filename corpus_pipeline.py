"""A corpus-building pipeline over ``documents``.

Each stage takes what its predecessor kept and calls one operator:

1. quality classifier: documents that it rejects go;
2. n-gram Jaccard join: the document of smallest id of each group stays;
3. benchmark decontamination: documents with a leak go;
4. PII: base entities become placeholders, revealing terms go;
5. mixing: documents are chosen to the target weights, with ``n_copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import decontamination, mixing, ngram_join, pii, quality
from foliospark.llm.common import discard, materialize, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii_sanitisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sanitised documents; ``n_chars`` follows the new text."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.select_rows(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii_sanitisation),
    ("mixing", source_mixing),
]
#: Stage 1 learns a model by EM, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
