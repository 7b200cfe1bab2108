"""Quality rules: repetition inside a document, and lines that too many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, words_of, written

#: Words in a window of the repetition rule.
WINDOW = 5
#: A table of frequent lines up to this many rows (16 bytes each) is broadcast.
BROADCAST_ROWS = 200_000


def with_repeated_words(df: DataFrame) -> DataFrame:
    """Add n_repeat_words: the words of ``_words`` in five-word windows found twice or more.

    Windows are compared by 64-bit hashes. ``array_distinct`` settles texts
    without repeats; others sort (hash, position) pairs, so that equal windows
    are neighbours, and add up the union of their word ranges.
    """
    same = lambda x, k: F.coalesce(x["h"] == F.get("_pairs", k)["h"], F.lit(False))
    return (
        df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_windows", F.when(F.size("_hashes") > WINDOW, F.transform(
            F.slice("_hashes", F.lit(1), F.size("_hashes") - (WINDOW - 1)),
            lambda h, i: F.xxhash64(h, *[F.get("_hashes", i + k) for k in range(1, WINDOW)]))))
        .withColumn("_pairs", F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("_places", F.sort_array(F.transform(
            F.filter("_pairs", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])))
        .withColumn("n_repeat_words", F.coalesce(F.aggregate(
            F.transform("_places", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", i + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0)))
        .drop("_hashes", "_windows", "_pairs", "_places")
    )


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    A null text has no words. Every count is of the whole text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = with_repeated_words(docs.withColumn("_words", words_of(whole)).withColumn("_lines", lines_of(whole)))
    return (
        counted.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
        .drop("_words")
    )


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def normal_line(line: Column) -> Column:
    """Lower case, digits as 0, runs of white space as one space: the form in which lines are equal."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), r"[\x20\x09-\x0D]+", " "))


def frequent_lines(lines: DataFrame, host_texts: DataFrame, min_docs: int, share: float) -> DataFrame:
    """(host, line) pairs above their host's limit.

    ``lines`` has one row for each document and distinct line: host, line (hash)
    and text (hash of the document's normalised lines). A line is above the limit when more than
    ``max(min_docs, share * texts of the host)`` different texts hold it. A
    group of copies counts as one text: its lines stand or fall by the others,
    and copies are left to near-duplicate removal.

    Both steps combine on the map side, so a line that a third of all
    documents hold costs one row for each task in the last exchange.
    """
    return (
        lines.distinct().groupBy("host", "line").agg(F.count("*").alias("n_texts"))
        .filter(F.col("n_texts") > min_docs)
        .join(host_texts, "host")
        .filter(F.col("n_texts") > share * F.col("host_texts"))
        .select("host", "line")
    )


def quality_rules(
    docs: DataFrame, host: str = "source", text: str = "text",
    min_docs: int = 10, share: float = 0.001, min_left: float = 0.2, min_words: int = 10,
) -> DataFrame:
    """Judge every row of ``docs``; return its columns with the base counts, removed_words, kept and clean_text.

    Lines are normalised and hashed; per host (null is a host of its own) the
    different texts that hold each line are counted, and lines above the limit
    (``frequent_lines``) are removed: ``clean_text`` is the text without them, all
    other lines as they came, and a null text stays null. A document is depleted when fewer
    than ``min_words`` words, or less than ``min_left`` of its words, remain
    although lines were removed. Rows that repeat a doc_id are documents of
    their own; a text of any length is judged whole. Columns of ``docs`` named like an added one are replaced; other
    columns pass through, whatever their names.

    Rows meet their frequent lines by 128 bits of host and text, so equal rows have equal fates and no row needs a number.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "kept", "clean_text")
    names = [c for c in docs.columns if c not in added]
    # The text itself goes along once only; a filler whose name is longer than any other keeps the struct from being empty.
    rest = F.struct(*[F.col(c) for c in names if c != text], F.lit(0).alias("".join(names) + "_"))
    row = docs.select(rest.alias("row"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(host).cast("string"), F.lit("\u0000"))).alias("host"))
    whole = F.coalesce(F.col("text"), F.lit(""))
    key = [F.xxhash64(F.lit(k), "host", whole).alias(f"k{k}") for k in (1, 2)]
    hashed = written(
        row.select("host", *key, lines_of(whole).alias("l"))
        .select("host", "k1", "k2", F.transform("l", lambda x: F.xxhash64(normal_line(x))).alias("l"))
        .select("host", "k1", "k2", F.xxhash64("l").alias("text"), F.array_distinct("l").alias("l")), "line-hashes")
    each = hashed.select("host", "text", F.explode("l").alias("line"))
    host_texts = hashed.select("host", "text").distinct().groupBy("host").agg(F.count("*").alias("host_texts"))
    frequent = written(frequent_lines(each, host_texts, min_docs, share), "frequent-lines")
    if frequent.count() <= BROADCAST_ROWS:
        frequent = F.broadcast(frequent)
    gone = (
        hashed.select("host", "k1", "k2", F.explode("l").alias("line"))
        .join(frequent, ["host", "line"], "left_semi")
        .groupBy("k1", "k2").agg(F.collect_set("line").alias("gone"))
    )
    is_gone = lambda x: F.array_contains("gone", F.xxhash64(normal_line(x)))
    removed = F.aggregate(F.filter(lines_of(whole), is_gone), F.lit(0).cast("long"), lambda n, x: n + F.size(words_of(x)))
    others = F.filter(F.split("text", "\n", -1), lambda x: ~is_gone(x))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((left < min_words) | (left < min_left * F.col("n_words")))
    # Counts are made below the join, and a verdict needs both of its sides: so no filter on it moves below
    # the counts, whose nested parts it would repeat again and again.
    return (
        base_counts(row.select("row", "text", *key)).drop("_lines").join(gone, ["k1", "k2"], "left").drop("k1", "k2")
        .withColumn("removed_words", F.when(F.col("gone").isNull(), F.lit(0)).otherwise(removed).cast("long"))
        .withColumn("kept", F.when(F.col("base_failed"), False).otherwise(~depleted))
        .withColumn("clean_text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(others, "\n")))
        .select(*[F.col("text" if c == text else f"row.`{c}`").alias(c) for c in names], *added)
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words", "clean_text")
