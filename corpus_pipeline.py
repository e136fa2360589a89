"""Documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns a frame that is written as Parquet and read again as the
next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm.common import stored, table
from bazaar.llm.queries import MAX_BITS, SHINGLE_WORDS, pack_documents, secret_forest, severity_grades
from bazaar.llm.secrets import redact
from bazaar.llm.simhash import one_of_each
from bazaar.llm.toxicity import fit, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go. Null and empty texts stay; repeated rows stay or go
    together; a text of any length is judged by its worst span; an empty table
    stays empty; further columns pass through."""
    return without_toxic(docs, fit(docs, severity_grades(table(spark, sf_dir, "labels"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the least
    id. Documents without words, null texts among them, are one group; of
    repeated rows one stays; texts of any length are shingled whole; an empty
    table stays empty; further columns pass through."""
    return one_of_each(docs, SHINGLE_WORDS, MAX_BITS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays, repeated rows,
    null and empty texts too. Texts of any length are read whole; an empty table
    stays empty; further columns pass through, ``n_chars`` made anew."""
    return redact(docs, secret_forest(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences. A null text is an empty one, of
    one token; repeated rows have places of their own; a text longer than a
    sequence is cut; an empty table has no pieces; other columns are left out."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", packing)]

# no SQL for a fitted classifier, SimHash or a tokenizer; tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
