"""Secret scans: patterns, and strings that look random to character models."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, written
from tidemark.llm.spans import apart_from, beside_columns, joined, with_matches

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
#: Strings that the models judge.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}+={0,2}"
BASE = ("assign", "access", "hex")

#: Characters of the models; any other counts as one more.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-=."
SIZE = len(ALPHABET) + 1
#: Labelled rows to learn from: at most so many documents with and without a base span, picked by hash from about so many.
SAMPLE_DOCS, SAMPLE_ROWS = 2_000, 100_000
#: Weight of single characters' shares against a row's own transitions.
BACK_OFF = 5.0
#: Log-likelihood ratio from which a string counts as random: the mean of its transitions, and their sum, which asks more of short strings.
THRESHOLD, EVIDENCE = 0.5, 15.0


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))


def with_base_spans(df: DataFrame) -> DataFrame:
    """Add _assign, _access and _hex for ``_text``."""
    t = F.col("_text")
    long_enough = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 6
    df = with_matches(df, "_assign", "_text", ASSIGN, t.rlike(r"[:=]") & t.rlike("(?i)passw|secret|token|api_?key"), long_enough)
    df = with_matches(df, "_access", "_text", ACCESS, F.contains(t, F.lit("AKIA")))
    return with_matches(df, "_hex", "_text", HEX, t.rlike("[0-9a-f]{24}"))


def labelled_samples(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(label, value): 1 for values that base patterns find, 0 for words of eight or more characters of other texts.

    One pass takes the texts whose hash is below what about ``sample_rows`` of all rows have, and of those
    without a base span what about twice ``sample_docs`` have; at most ``sample_docs`` texts of each kind,
    those with the smallest hashes, are used. The bounds hold at every size and only the models depend on them.
    """
    n = max(docs.count(), 1)
    below = lambda rows: F.col("_order") <= F.lit(min(2**63 - 1, -(2**63) + int(min(1.0, rows / n) * 2**64))).cast("long")
    marked = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
    rows = _texts(docs, text).select("_text", F.xxhash64("_text").alias("_order")).filter(below(sample_rows))
    rows = rows.withColumn("label", F.col("_text").rlike(marked).cast("int")).filter((F.col("label") == 1) | below(2 * sample_docs))
    values = F.concat(
        F.transform("_assign", lambda x: F.regexp_extract(x["hit"], ASSIGN, 2)),
        F.transform("_access", lambda x: x["hit"]), F.transform("_hex", lambda x: x["hit"]))
    words = F.regexp_extract_all("_text", F.lit(r"[A-Za-z_][A-Za-z0-9_/.-]{7,}"), F.lit(0))
    found = written(with_base_spans(rows).select("label", "_order", F.when(F.col("label") == 1, values).otherwise(words).alias("values")).dropDuplicates(["_order"]), "samples")
    some = lambda label: found.filter(F.col("label") == label).orderBy("_order").limit(sample_docs).select("label", F.explode("values").alias("value"))
    return some(1).unionAll(some(0))


def _index(char: Column) -> Column:
    """Place in the alphabet from 0; SIZE - 1 for what it lacks."""
    return (F.instr(F.lit(ALPHABET), char) + (SIZE - 1)) % SIZE


def _transitions(value: Column) -> Column:
    """from * SIZE + to for each pair of neighbouring characters."""
    codes = F.transform(F.split(value, ""), _index)
    return F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0))), lambda a, b: a * SIZE + b)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each transition of two first-order Markov models.

    Transitions are counted in Spark; the SIZE * SIZE counts of each label come
    to the driver, where each row is mixed with the shares of single characters
    (``BACK_OFF`` transitions' worth), which are smoothed by one.
    """
    counted = (
        samples.filter(F.length("value") > 1).select("label", F.explode(_transitions(F.col("value"))).alias("pair"))
        .groupBy("label", "pair").count().collect()
    )
    counts = [[0.0] * (SIZE * SIZE), [0.0] * (SIZE * SIZE)]
    for r in counted:
        counts[r["label"]][r["pair"]] += r["count"]
    logs = []
    for table in counts:
        single = [1 + sum(table[to::SIZE]) for to in range(SIZE)]
        share = [v / sum(single) for v in single]
        rows = [sum(table[k * SIZE:(k + 1) * SIZE]) for k in range(SIZE)]
        logs.append([math.log((v + BACK_OFF * share[i % SIZE]) / (rows[i // SIZE] + BACK_OFF)) for i, v in enumerate(table)])
    return [r - o for o, r in zip(*logs)]


def likelihood_ratio(value: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of the transitions of ``value``; positive: more like the random strings."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    steps = _transitions(value)
    return F.aggregate(steps, F.lit(0.0), lambda acc, p: acc + F.element_at(table, p + 1)) / F.greatest(F.size(steps), F.lit(1))


def _ranked(kind: str, rank: int) -> Column:
    return F.transform(f"_{kind}", lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def scan_secrets(docs: DataFrame, model: list[float], text: str = "text", threshold: float = THRESHOLD, evidence: float = EVIDENCE) -> DataFrame:
    """Add n_assign, n_access, n_hex, ``base`` and ``spans``.

    ``base`` and ``spans`` are arrays of (kind, start, end) by start, then kind
    as listed; ``spans`` adds kind ``random``: strings of 12 or more characters that overlap no base span
    and whose transitions have a log-likelihood ratio above ``threshold`` in the mean and of ``evidence`` or more in all. Null and empty
    texts have none; a text of any length is scanned whole; every row stands for itself. Columns of ``docs`` with these names are replaced, all others stay.
    """
    return beside_columns(docs, text, lambda df, own: _with_secrets(df, own, model, threshold, evidence), (*[f"n_{k}" for k in BASE], "base", "spans"))


def _with_secrets(docs: DataFrame, text: str, model: list[float], threshold: float, evidence: float) -> DataFrame:
    df = with_base_spans(_texts(docs, text))
    df = with_matches(df, "_candidates", "_text", CANDIDATE, F.col("_text").rlike("[A-Za-z0-9+/_-]{12}"), lambda hit: looks_random(hit, model, threshold, evidence))
    df = df.withColumn("_base", F.concat(*[f"_{k}" for k in BASE])).withColumn("_random", apart_from("_candidates", "_base"))
    ranked = lambda names: F.transform(
        F.sort_array(F.concat(*[_ranked(k, i) for i, k in enumerate(names)])),
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    df = df.withColumn("base", ranked(BASE)).withColumn("spans", ranked((*BASE, "random")))
    for k in BASE:
        df = df.withColumn(f"n_{k}", F.size(f"_{k}").cast("long"))
    return df.drop("_text", "_candidates", "_base", "_random", *[f"_{k}" for k in BASE])


def looks_random(value: Column, model: list[float], threshold: float = THRESHOLD, evidence: float = EVIDENCE) -> Column:
    """Whether both bounds are passed; digits alone are a number, not a string."""
    return value.rlike("[A-Za-z]") & (likelihood_ratio(value, model) > F.greatest(F.lit(threshold), F.lit(evidence) / F.greatest(F.length(value) - 1, F.lit(1))))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = scan_secrets(docs, train(labelled_samples(docs)))
    return found.select(
        "doc_id", *[f"n_{k}" for k in BASE], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
