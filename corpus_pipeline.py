"""From raw documents to packed training sequences, one operator per stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each
result as a table in the shared folder and reads it again for the next stage. All but the last
return the columns of documents. Rows without id or text go through every stage like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm import dartminhash, mixing, packing, substrings, toxicity
from siteweave.llm.common import prepare, written
from siteweave.sources.tables import read_table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, trained on the labels, rejects go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return dartminhash.drop_near_duplicates(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that repeat go; every document stays, with the words it has left.

    A document without repeats keeps its text as it is. The number of characters is counted again.
    """
    cut = substrings.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    columns["text"] = F.when(changed, F.col("kept_text")).otherwise(columns["text"])
    if "n_chars" in columns:
        count = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, count).otherwise(columns["n_chars"])
    return cut.select(*[column.alias(c) for c, column in columns.items()])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, up to three times."""
    return mixing.repeat_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of documents in sequences of at most 2048 tokens."""
    return packing.packed_documents(docs, packing.tokenizer_path())


STAGES = [
    ("toxicity", clean),
    ("near duplicates", distinct),
    ("repeated passages", unrepeated),
    ("mixing", mixed),
    ("packing", packed),
]

# Trained dictionaries, sampled signatures and a seeded choice are beyond SQL; the tests
# hold every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
