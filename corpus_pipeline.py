"""Documents to training sequences: quality, near-duplicates, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of `documents`. A stage holds for any input with these columns: NULL in
any of them, repeated rows, empty texts and no rows at all; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcframe.llm import mixing, packing, quality, secrets, shingles
from cdcframe.llm.common import remainder, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: SQL cannot express the stages (compression, tokenizer ids); `tests/llm/test_pipeline.py` has them in plain Python.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels of the folder, as the query does."""
    docs = docs.select(*COLUMNS)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, Jaccard similarity 0.8 or more) the document with the smallest
    id. Candidates come from covering SimHash, then from minima of the sets. Texts without words are one group."""
    return shingles.keep_one(docs.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and the number of characters counted anew."""
    return _counted(secrets.mask_secrets(docs.select(*COLUMNS)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mixture takes: documents whole or in part, repeats as rows, what is not taken left out."""
    docs = docs.select(*COLUMNS)
    return _counted(mixing.mixed_texts(docs, mixing.mix(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
