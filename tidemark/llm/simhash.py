"""SimHash fingerprints, and all neighbours within a Hamming radius by permuted block tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import doc_ids, documents, power_bounds, with_null_ids, with_range_bucket, written

BITS = 64
#: Rows in a range of doc_ids that is sorted at once.
BUCKET_ROWS = 2048
LANES = 0x0000000100000001


def terms_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; one empty term for a text that has none."""
    found = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")
    return F.when(F.size(found) == 0, F.array(F.lit(""))).otherwise(found)


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys and ``fp`` (bigint): each pair of neighbouring terms votes on 64 bits with the weight of its length.

    A bit is set if more than half of the weight voted for it. The ones of
    bits i and i + 32 are summed in two halves of one bigint, so 32 sums do for 64 bits; all weights
    of a text come to at most twice its length, and Spark's limit of 2 GB for a text keeps that below 2^32. Equal texts have equal
    fingerprints. ``keys`` must name the rows; a null text counts as empty.
    """
    words = texts.select(*keys, terms_of(F.coalesce(F.col(text), F.lit(""))).alias("_terms"))
    pairs = words.select(*keys, "_terms", F.posexplode("_terms").alias("_i", "_term"))
    after = F.get("_terms", F.col("_i") + 1)
    votes = pairs.select(
        *keys, F.xxhash64("_term", after).alias("_h"),
        (F.length("_term") + F.coalesce(F.length(after), F.lit(0))).cast("long").alias("_n"),
    ).withColumn("_w", F.greatest(F.col("_n"), F.lit(1).cast("long")))
    half = F.lit(LANES).cast("long")
    sums = votes.groupBy(*keys).agg(
        F.sum("_w").alias("_all"),
        *[F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(half) * F.col("_w")).alias(f"_s{i}") for i in range(BITS // 2)])
    fp = F.lit(0).cast("long")
    for i in range(BITS // 2):
        low, high = F.col(f"_s{i}").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), F.shiftrightunsigned(f"_s{i}", 32)
        for at, ones in ((i, low), (i + 32, high)):
            bit = 1 << at
            fp = fp.bitwiseOR(F.when(2 * ones > F.col("_all"), F.lit(bit - (1 << 64) if at == 63 else bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _mask(blocks: list[tuple[int, int]]) -> int:
    mask = sum(((1 << size) - 1) << at for at, size in blocks)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def tables(radius: int, extra: int = 3) -> list[int]:
    """Masks of the permuted tables: all choices of ``extra`` out of ``radius + extra`` blocks.

    Two fingerprints that differ in at most ``radius`` bits agree on at least
    ``extra`` whole blocks, so on the bits of at least one mask.
    """
    n = radius + extra
    cuts = [BITS * i // n for i in range(n + 1)]
    blocks = [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(n)]
    return [_mask(list(c)) for c in combinations(blocks, extra)]


def neighbours(queries: DataFrame, fps: DataFrame, radius: int = 3) -> DataFrame:
    """(query, fp): every distinct fingerprint of ``fps`` within ``radius`` bits of a distinct one of ``queries``, itself too.

    Both have a column ``fp``. Each fingerprint goes into one table for each
    mask, under its bits there (about half of them, so that buckets stay small as the corpus
    grows); Hamming distance is checked in the join, and a pair that meets in
    several tables is taken in the first of them only. Equal fingerprints are
    collapsed before, so a group of copies is one entry. AQE splits hot buckets.
    """
    masks = tables(radius)
    keyed = lambda df, name: df.select("fp").distinct().select(
        F.col("fp").alias(name),
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("table", "block"))
    differ = F.col("query").bitwiseXOR(F.col("fp"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(t)) for t, m in enumerate(masks)])
    a, b = keyed(queries, "query"), keyed(fps, "fp").withColumnsRenamed({"table": "table_", "block": "block_"})
    return a.join(b, (F.col("block") == F.col("block_")) & (F.col("table") == F.col("table_")) & (F.bit_count(differ) <= radius) & (first == F.col("table"))).select("query", "fp")


def with_next(docs: DataFrame, text: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """bucket, n, doc_id, text, next_text, ghost: each document with the text of the next by doc_id; the last with the first's.

    Ties of doc_id go by text. Ranges of doc_ids are sorted each for itself; every range also
    gets, as a ghost row, the first document of the next, so no sort or window spans the table.
    """
    rows = docs.select(doc_ids(), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds = power_bounds(rows.select("doc_id"), "doc_id", bucket_rows)
    rows = with_range_bucket(rows, "doc_id", bounds)
    # At most one row for each range, and there are at most 65,536.
    firsts = [tuple(r) for r in with_range_bucket(docs.select(doc_ids()), "doc_id", bounds)
              .groupBy("bucket").agg(F.min("doc_id").alias("first")).orderBy("bucket").collect()]
    heads = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    heads = docs.sparkSession.createDataFrame(heads, "doc_id long, previous int")
    both = rows.join(F.broadcast(heads), "doc_id", "left").select(
        "doc_id", "text",
        F.explode(F.when(F.col("previous").isNull(), F.array(F.struct(F.col("bucket"), F.lit(False).alias("ghost"))))
                  .otherwise(F.array(F.struct(F.col("bucket"), F.lit(False).alias("ghost")), F.struct(F.col("previous").alias("bucket"), F.lit(True).alias("ghost"))))).alias("at"),
    ).select("at.bucket", "at.ghost", "doc_id", "text")
    order = Window.partitionBy("bucket").orderBy("ghost", "doc_id", "text")
    return both.select("bucket", F.row_number().over(order).alias("n"), "doc_id", "ghost", "text", F.lead("text").over(order).alias("next_text"))


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last half replaced by as much of the start of ``next_text``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def op4_simhash(spark: SparkSession, sf_dir: str, radius: int = 3) -> DataFrame:
    """The contract's columns, and n_near for every hundredth doc_id: documents within ``radius`` bits of it, itself too."""
    rows = with_next(documents(spark, sf_dir).select("doc_id", "text"), bucket_rows=BUCKET_ROWS)
    change = F.coalesce(edited(F.col("text"), F.coalesce("next_text", F.lit(""))), F.lit(""))
    sides = F.when(F.col("ghost"), F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), change.alias("t"))))
    both = rows.select("bucket", "n", F.explode(sides).alias("x")).select("bucket", "n", "x.side", "x.t")
    votes = fingerprints(both, ["bucket", "n", "side"], "t")
    # The rows stay where the first exchange, by bucket, has put them.
    pair = votes.groupBy("bucket", "n").agg(F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("b"))
    about = rows.select("bucket", "n", "doc_id", "ghost", F.length("text").cast("long").alias("n_chars"), F.sha2(change, 256).alias("edited_sha256"))
    joined = about.join(pair, ["bucket", "n"]).withColumn("next", F.lead("a").over(Window.partitionBy("bucket").orderBy("n")))
    found = written(with_null_ids(joined.filter(~F.col("ghost"))), "fingerprints")
    queries = found.filter(F.col("doc_id") % 100 == 0)
    sizes = found.groupBy("a").agg(F.count("*").alias("docs"))
    near = neighbours(queries.select(F.col("a").alias("fp")), sizes.select(F.col("a").alias("fp")), radius)
    near = near.join(sizes, near["fp"] == sizes["a"]).groupBy("query").agg(F.sum("docs").alias("n_near"))
    text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return (
        found.join(near, (found["a"] == near["query"]) & (found["doc_id"] % 100 == 0), "left")
        .select(
            "doc_id", "n_chars", "edited_sha256", text("a").alias("fingerprint"), text("b").alias("edited_fingerprint"),
            likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("next")).alias("near_next"), "n_near")
    )
