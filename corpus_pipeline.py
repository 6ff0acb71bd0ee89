"""Documents -> a training mix: the stages, in order, and the run over all of them.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns those
it keeps with the columns of ``documents``; the last adds what the mix takes of each row.
Every stage's rows are written to the folder that executors share and read again, so a
lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import fingerprints, mixture, ppm, tiling, toccurrence
from tracewell.llm.queries import language_model, table
from tracewell.llm.shared import bounded_batches, written

#: A document's language is accepted when its share of the evidence is at least this,
LEAST_SCORE = 0.5
#: and when the language's model does better than storing plain bytes.
MOST_BITS = 8.0


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rows without a letter, or that no language explains, go."""
    bounded_batches(spark)
    found = ppm.predict(docs, language_model(docs), "text", "_language")
    good = (F.col("_language.lang") != ppm.UNDETERMINED) & (F.col("_language.score") >= LEAST_SCORE)
    return found.filter(good & (F.col("_language.bits_per_byte") < MOST_BITS)).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest doc_id stays."""
    bounded_batches(spark)
    return fingerprints.deduplicate(docs, "doc_id", "text")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates: five-word shingles, Jaccard 0.8; of linked documents one stays."""
    bounded_batches(spark)
    return toccurrence.one_of_each(docs, "doc_id", "text", size=5, at_least=80, of=100)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold a benchmark item go."""
    return tiling.clean(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix to target weights: documents that the mix takes, with ``size`` (words) and
    ``taken`` (words, repeats counted)."""
    bounded_batches(spark)
    out, _, _ = mixture.mix(docs, "doc_id", mixture.word_count("text"), F.array("source"))
    return out.filter("_taken > 0").select(*docs.columns, F.col("_size").alias("size"), F.col("_taken").alias("taken"))


STAGES = [
    ("language_id", identified),
    ("exact_dedup", deduplicated),
    ("jaccard_join", distinct),
    ("decontamination", decontaminated),
    ("source_mix", mixed),
]

#: Models and seeded selection have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
