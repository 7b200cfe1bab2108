"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import minhash, mixing, packing, pii, quality
from tidemark.llm.common import documents, written


def _apart(docs: DataFrame) -> DataFrame:
    """doc_id, text and source, and the other columns in ``_rest``: so none of them clashes with those that an operator adds."""
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "text", "source")]
    filler = F.lit(0).alias("".join(docs.columns) + "_")  # longer than any name; a struct must not be empty
    return docs.select("doc_id", "text", "source", F.struct(*rest, filler).alias("_rest"))


def _rows(df: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` again, with ``text`` as their text."""
    at = {"doc_id": "doc_id", "source": "source", "text": text}
    return df.select(*[F.col(at.get(c, f"_rest.`{c}`")).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and from the others the lines that too many texts of a host share; n_chars stays as dealt."""
    return _rows(quality.quality_rules(_apart(docs)).filter("kept"), docs, "clean_text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return minhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets."""
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated until weights are even enough, at most twice; every document appears, in the order of the mixture's blocks."""
    mixed = mixing.mix_sources(_apart(docs))
    return _rows(mixed.repartitionByRange("mix_block").sortWithinPartitions("mix_block", "mix_place"), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Signatures, tokens and best-fit placement have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
