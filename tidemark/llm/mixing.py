"""Temperature mixing of sources to target weights, realised as budgeted block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, written

#: A plan of up to so many sources is broadcast; its rows are of fixed size.
BROADCAST_SOURCES = 100_000
#: Bits of a permutation key that name its block, within a source.
BLOCK_BITS = 14
#: Exponents that one aggregation tries at a time.
SECTIONS = 32


def _source(source: str) -> Column:
    return F.coalesce(F.col(source).cast("string"), F.lit("\u0000"))


def token_count(text: str) -> Column:
    """Runs of letters, single digits and runs of other signs: what public tokenizers cut a text into first, and SQL can count."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"\p{L}+|\p{N}|[^\p{L}\p{N}\s]+")).cast("long")


def find_exponent(totals: DataFrame, target_entropy: float | None, max_repeat: float | None, budget: int | None = None, rounds: int = 5) -> float:
    """The largest exponent in [0, 1] whose weights are even enough, raised where repetition would pass its limit.

    ``totals`` has a row with ``tokens`` > 0 for each source. Weights are
    shares to the exponent, normalised; ``target_entropy`` is a part of the
    entropy of equal weights. Exponent 1 keeps the shares, 0 makes all weights equal; entropy and
    repetition both fall as it rises. Most repeated is the smallest source, by its weight of ``budget``
    tokens or, without a budget, against the largest, which then comes once. Each round cuts the interval
    into ``SECTIONS`` by one aggregation.
    """
    row = totals.agg(F.sum("tokens").alias("all"), F.max("tokens").alias("top"), F.min("tokens").alias("low"), F.count("*").alias("n")).first()
    if not row["n"] or row["n"] == 1:
        return 1.0
    lp = F.ln(F.col("tokens") / F.lit(float(row["all"])))

    def entropies(exponents: list[float]) -> list[float]:
        sums = [x for a in exponents for x in (F.sum(F.exp(lp * a)), F.sum(F.exp(lp * a) * lp * a))]
        got = totals.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        return [math.log(got[2 * i]) - got[2 * i + 1] / got[2 * i] for i in range(len(exponents))]

    def most_repeated(exponents: list[float]) -> list[float]:
        if budget is None:
            return [(row["top"] / row["low"]) ** (1 - a) for a in exponents]
        got = totals.agg(*[F.sum(F.pow("tokens", F.lit(a))).alias(f"s{i}") for i, a in enumerate(exponents)]).first()
        return [budget * row["low"] ** (a - 1) / s for a, s in zip(exponents, got)]

    def bisect(holds) -> float:
        """The end of the interval from 0 in which ``holds``."""
        low, high = 0.0, 1.0
        for _ in range(rounds):
            points = [low + (high - low) * k / SECTIONS for k in range(1, SECTIONS + 1)]
            passed = [p for p, ok in zip(points, holds(points)) if ok]
            low, high = (max(passed), min([p for p in points if p > max(passed)], default=high)) if passed else (low, points[0])
            if low >= 1.0:
                return 1.0
        return low

    found = 1.0
    if target_entropy is not None:
        goal = target_entropy * math.log(row["n"])
        found = bisect(lambda points: [h >= goal for h in entropies(points)])
    if max_repeat is not None:
        over = bisect(lambda points: [r > max_repeat for r in most_repeated(points)])
        found = max(found if target_entropy is not None else 0.0, over)
    return found


def mixing_plan(weighed: DataFrame, target_entropy: float | None, max_repeat: float | None, budget: int | None = None) -> DataFrame:
    """One row for each source: weight, repeats, full epochs and the key up to which the last epoch goes.

    ``weighed`` has src, tokens and key of each document. With a ``budget`` of tokens, each source
    gets its weight of it; without one the largest source is taken once, so that every document appears, and the budget of a source is its
    weight against that. A source's last, partial epoch takes documents in
    the order of their keys as long as their tokens fit: totals of (source, block)
    show in which block the budget ends, and only that block is sorted.
    """
    blocks = weighed.groupBy("src", F.shiftright("key", 64 - BLOCK_BITS).alias("block")).agg(F.sum("tokens").alias("tokens"))
    blocks = written(blocks, "mixing-blocks")
    totals = blocks.groupBy("src").agg(F.sum("tokens").alias("tokens"))
    some = totals.filter("tokens > 0")
    exponent = find_exponent(some, target_entropy, max_repeat, budget)
    all_, top, powers = some.agg(F.sum("tokens"), F.max("tokens"), F.sum(F.pow("tokens", F.lit(exponent)))).first()
    share = F.greatest(F.col("tokens"), F.lit(1)) / F.lit(float(all_ or 1))
    of = F.greatest(F.col("tokens"), F.lit(1))
    times = F.pow(F.lit(float(top or 1)) / of, F.lit(1 - exponent)) if budget is None else F.lit(budget / (powers or 1.0)) * F.pow(of, F.lit(exponent - 1))
    repeats = F.when(F.col("tokens") > 0, times).otherwise(F.lit(1.0))
    if max_repeat is not None:
        repeats = F.least(repeats, F.lit(float(max_repeat)))  # rounding of the exponent must not pass the limit
    plan = (
        totals.withColumn("repeats", repeats).withColumn("temperature_weight", F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent))).otherwise(F.lit(0.0)))
        .withColumn("epochs", F.floor("repeats").cast("long"))
        .withColumn("budget", F.floor(F.col("repeats") * F.col("tokens")).cast("long"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    )
    before = F.sum("tokens").over(Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    last = (
        blocks.withColumn("before", F.coalesce(before, F.lit(0)))
        .join(plan.select("src", "rest"), "src")
        .filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("tokens") >= F.col("rest")))
        .groupBy("src").agg(F.min("block").alias("block"), F.min_by("before", "block").alias("before"), F.first("rest").alias("rest"))
    )
    # Keys of the block in which the budget ends, with the tokens up to each.
    inside = (
        weighed.withColumn("block", F.shiftright("key", 64 - BLOCK_BITS))
        .join(_small(last), ["src", "block"])
        .withColumn("upto", F.col("before") + F.sum("tokens").over(Window.partitionBy("src").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)))
        .groupBy("src").agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("key"))).alias("cut"), F.first("block").alias("block"))
        # Nothing of this block fits: the last epoch ends where the block begins.
        .select("src", F.coalesce("cut", F.shiftleft("block", 64 - BLOCK_BITS) - 1).alias("cut"), "block")
        .select("src", F.when((F.col("block") == -(2 ** (BLOCK_BITS - 1))) & (F.col("cut") > 2**62), F.lit(None)).otherwise(F.col("cut")).alias("cut"))
    )
    return plan.join(inside, "src", "left").select("src", "tokens", "temperature_weight", "repeats", "epochs", "budget", "cut")


def _small(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it has at most ``BROADCAST_SOURCES`` rows of fixed size."""
    df = written(df, "mixing-plan")
    return F.broadcast(df) if df.count() <= BROADCAST_SOURCES else df


def mix_sources(docs: DataFrame, source: str = "source", text: str = "text", target_entropy: float | None = 0.98, max_repeat: float | None = 2.0,
                block_tokens: int = 1 << 20, seed: int = 7, budget: int | None = None, tokens: str | None = None) -> DataFrame:
    """``docs`` with a row for each copy that the mixture takes, and n_tokens, epoch, mix_block and mix_place.

    Sources weigh their share of tokens to an exponent (``find_exponent``). Tokens are those of column
    ``tokens`` (as of a tokenizer; null counts as none) or else what ``token_count`` finds. Without a ``budget`` of tokens no document is
    dropped: the largest source comes once, others up to ``max_repeat`` times; with one, sources may come in part.
    Each epoch of a source orders its documents by a keyed hash; a copy's
    place in its source's budget gives mix_block, so that each of the blocks of about
    ``block_tokens`` holds all sources by weight. Inside its block a copy stands by mix_place, another keyed hash: sorted
    by both, rows are a permutation block by block. A null source is a source of
    its own; null texts have no tokens and are taken in full epochs only, those of a source without tokens once. Rows that are equal share
    their key and so their fate. Columns of ``docs`` with the added names are replaced; others pass through, whatever their names.
    """
    names = [c for c in docs.columns if c not in ("epoch", "n_tokens", "mix_block", "mix_place")]
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce(F.col(text), F.lit("")))
    n = token_count(text) if tokens is None else F.coalesce(F.col(tokens).cast("long"), F.lit(0))
    marked = docs.select(F.struct(*names).alias("row"), n.alias("n_tokens"), _source(source).alias("src"), key.alias("key"))
    weighed = written(marked.select("src", F.col("n_tokens").alias("tokens"), "key"), "mixing-keys")
    plan = written(mixing_plan(weighed, target_entropy, max_repeat, budget), "mixing")
    n_blocks = max(1, -(-(plan.agg(F.sum("budget")).first()[0] or 0) // block_tokens))
    found = _small(plan.select("src", "repeats", "epochs", "cut"))
    # Epochs but the last are ordered by keys of their own; the last by the key that its cut refers to.
    place = lambda k: (k.cast("double") / 2.0**64 + 0.5)
    last = F.col("epoch") > F.col("epochs")
    return (
        marked.join(found, "src")
        .withColumn("n", F.col("epochs") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)).filter("n > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .withColumn("at", (F.col("epoch") - 1 + F.when(last, place(F.col("key"))).otherwise(place(F.xxhash64("key", "epoch")))) / F.col("repeats"))
        .withColumn("mix_block", F.least(F.floor(F.col("at") * n_blocks).cast("long"), F.lit(n_blocks - 1)))
        .withColumn("mix_place", F.xxhash64(F.lit(seed), "key", "epoch", F.lit("place")))
        .select(*[F.col("row")[c].alias(c) for c in names], "n_tokens", "epoch", "mix_block", "mix_place")
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "source", "n_tokens", "epoch", "mix_block", "mix_place")
