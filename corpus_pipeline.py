"""The documents table as training sequences: toxic documents go, one of each group of
near-duplicates stays, passages that repeat an earlier document go, and the rest is packed.

Every stage takes and returns whole tables; all but the last keep the columns of documents,
whatever else these are called.

* Nulls: a null text counts as empty and stays null.  Rows without doc_id pass the
  near-duplicate and passage stages as they are.
* Empty texts: in no group of near-duplicates; a document whose whole text goes stays, empty.
* Ties: the smallest doc_id of a group stays.  Where a passage is in several documents, the
  smallest doc_id keeps it.
* Repeated rows: a doc_id that is dropped as near-duplicate is dropped with all its rows.
  Rows of equal doc_id keep what they share with each other, and lose what they share with a
  smaller one.  Packing gives each row its own pieces.
* Empty tables: every stage gives an empty table with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.llm.minhash import near_duplicates
from formfold.llm.queries import packed, ship, table
from formfold.llm.shared import free_name, stage
from formfold.llm.suffixes import remove_repeats
from formfold.llm.toxicity import fit, score_documents

#: Any passage of more than 50 words has at least this many bytes.
PASSAGE_BYTES = 100


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a classifier trained on the labels calls toxic."""
    ship(spark)
    network = fit(docs, table(spark, sf_dir, "labels"))
    made = free_name(docs.columns, "toxicity")
    return score_documents(docs, network, made).where(F.col(f"{made}.predicted") == 0).select(docs.columns)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of documents that share 0.8 of their five-word shingles."""
    ship(spark)
    gone = near_duplicates(docs, width=5, percent=80).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what is covered by strings that start in a document of smaller doc_id."""
    ship(spark)
    made = free_name(docs.columns, "removal")
    left = remove_repeats(docs, length=PASSAGE_BYTES, characters=True, into=made)
    shorter = F.col(f"{made}.n_removed") > 0
    text = F.when(shorter, F.decode(f"{made}.kept", "UTF-8")).otherwise(F.col("text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(shorter, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return left.withColumns(changed).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1024 tokens."""
    ship(spark)
    return packed(docs, remembered=600_000)  # workers still hold what earlier stages learnt


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicate_groups),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: SQL cannot express a trained classifier; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
