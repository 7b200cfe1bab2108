"""Token counts by a map-side lookup in two tiers."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import Encoder
from tidemark.llm.common import documents

#: Documents from whose texts the frequent pre-tokens are taken, and how many pre-tokens are broadcast.
SAMPLE_DOCS, TABLE_SIZE = 2_000, 50_000

_workers: dict[str, Encoder] = {}


def frequent_lengths(docs: DataFrame, text: str, tokenizer: str, sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE) -> tuple[str, bytes]:
    """The first tier: the pre-tokens that are frequent in a bounded sample of documents, by lines, and their token counts (up to 255), a byte each.

    It only saves work: pre-tokens that it lacks are encoded, so counts do not
    depend on the sample. Both bounds hold whatever the table's size, and no
    pre-token is shuffled.
    """
    enc, seen = Encoder(tokenizer), Counter()
    for row in docs.select(F.col(text).alias("t")).filter(F.length("t") < 20_000).take(sample_docs):
        for part in enc.parts(row.t):
            seen.update(enc.pre_tokens(part))
    found = [(p, n) for p, _ in seen.most_common(table_size) if "\n" not in p and (n := enc.lengths[p]) < 256]
    return "\n".join(p for p, _ in found), bytes(n for _, n in found)


def token_counts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", text: str = "text", limit: int = 2048,
                 sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE) -> DataFrame:
    """Add n_bytes, n_tokens and over_limit to ``docs``; no shuffle, one pass.

    A null text counts as empty. Columns of ``docs`` with these names are
    replaced. Each Python worker looks pre-tokens up in the broadcast table, then
    in a bounded cache of its own, and encodes what neither has; a second cache keeps sums for
    the parts of texts between white space. A text of any length is counted whole, part by part.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text, tokenizer, sample_docs, table_size))
    run = uuid.uuid4().hex
    names = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    whole = F.coalesce(F.col(text), F.lit(""))

    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if run not in _workers:  # a worker that is used again keeps its cache
            _workers.clear()
            known, lengths = table.value
            _workers[run] = Encoder(tokenizer, dict(zip(known.split("\n"), lengths)))
        for series in texts:
            yield pd.Series([_workers[run].count(t) for t in series], dtype="int64")

    count = F.pandas_udf(counted, "bigint")
    return (
        docs.select(*names, F.octet_length(whole).cast("long").alias("n_bytes"), count(whole).alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")
