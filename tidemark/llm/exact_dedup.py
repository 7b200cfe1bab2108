"""Exact duplicates by content sort: sampled splitters, one sort in each range, comparison of neighbours."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, with_range_bucket, written

#: Rows that a range holds on average, sampled keys for each splitter, and ranges at most.
BUCKET_ROWS, SAMPLED, MOST_BUCKETS = 2048, 16, 65_536
#: Hexadecimal digits of a key without its identifier: 16 bytes of the text, 64 bits of its hash.
STEM = 48


def _digits(number: Column) -> Column:
    return F.lpad(F.hex(number), 16, "0")


def sort_key(text: Column, doc_id: Column) -> Column:
    """Where a row lies: the text's first 16 bytes, its hash, its identifier.

    Such keys are short whatever the text. Texts with a long common start part by their hashes, and a large
    group of copies by its identifiers, so no range holds much more than its share.
    """
    start = F.rpad(F.hex(F.substring(text.cast("binary"), 1, 16)), 32, "0")
    return F.concat(start, _digits(F.xxhash64(text)), _digits(F.xxhash64(doc_id)))


def splitters(keys: DataFrame, bucket_rows: int = BUCKET_ROWS, most: int = MOST_BUCKETS) -> list[str]:
    """Ascending bounds of ranges of about equal numbers of rows, from a sample of at most some ``SAMPLED * most`` keys of 64 digits.

    The sample decides about the balance of ranges only, never about results.
    """
    n, buckets = keys.count(), 1
    while buckets * bucket_rows < n and buckets < most:
        buckets *= 2
    if buckets == 1:
        return []
    sample = sorted(r[0] for r in keys.sample(min(1.0, SAMPLED * buckets / n), seed=12).collect())
    return [sample[len(sample) * i // buckets] for i in range(1, buckets)] if len(sample) >= buckets else []


def exact_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest",
    normal: Callable[[Column], Column] | None = None, texts: bool = True, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256, one row for each of its rows.

    Texts are equal if all bytes are, after ``normal`` (nothing by default). Of equal texts the ``smallest`` or
    ``largest`` doc_id stays; of rows that share it, one. A null text counts as empty. A row without a doc_id stays only if no row of
    its group has one; keep_id is null then. Columns of ``docs`` named like an added one are replaced; other
    columns pass through, whatever their names; without ``texts`` the text itself is left out. An empty table gives an empty one.

    Rows are range-partitioned by ``sort_key`` with sampled splitters and sorted by text in each range; each text is compared
    in full with its neighbours. A group that a splitter cuts (its start and hash are the splitter's) is put
    together again by its SHA-256: at most about one group for each splitter, so that table is small and joined by broadcast.
    Texts are shuffled once. Rows equal in text and doc_id share a range.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    added = ("keep_id", "group_size", "kept", "text_sha256")
    names = [c for c in docs.columns if c not in added and (texts or c != text)]
    # The text goes along once only; a filler whose name is longer than any other keeps the struct from being empty.
    rest = F.struct(*[F.col(c) for c in names if c != text], F.lit(0).alias("".join(names) + "_"))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    given = F.col(text).alias("text") if normal else F.col(text).isNull().alias("no_text")
    rows = docs.select(rest.alias("row"), F.col(doc_id).alias("id"), (normal(whole) if normal else whole).alias("content"), given)
    bounds = splitters(rows.select(sort_key(F.col("content"), F.col("id"))), bucket_rows)
    rows = with_range_bucket(rows.withColumn("key", sort_key(F.col("content"), F.col("id"))), "key", bounds, kind="string")
    stem = F.substring("key", 1, STEM)
    rows = rows.withColumn("cut", F.lit(False))
    if bounds:
        stems = F.split(F.lit(",".join(b[:STEM] for b in bounds)), ",")
        rows = rows.withColumn("cut", stem.eqNullSafe(F.get(stems, F.col("bucket") - 1)) | stem.eqNullSafe(F.get(stems, F.col("bucket"))))
    rows = rows.withColumn("text_sha256", F.sha2(F.col("content").cast("binary"), 256)).drop("key")
    best = F.max if keep == "largest" else F.min
    order = Window.partitionBy("bucket").orderBy("content", F.col("id").asc_nulls_first() if keep == "largest" else F.col("id").desc_nulls_first())
    before, after = F.lag("content").over(order), F.lead("content").over(order)
    told = (
        rows.withColumn("first", before.isNull() | (before != F.col("content"))).withColumn("last", after.isNull() | (after != F.col("content")))
        .withColumn("run", F.sum(F.col("first").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    back = F.col("text") if normal else F.when(~F.col("no_text"), F.col("content"))
    told = told.select("row", "id", "cut", "bucket", "run", "last", "text_sha256", *([back.alias("text")] if text in names else []))
    run = Window.partitionBy("bucket", "run")
    told = told.withColumn("n", F.count("*").over(run)).withColumn("best", best("id").over(run)).drop("bucket", "run")
    if bounds:
        told = written(told, "runs")
        joined = told.filter("cut and last").groupBy("text_sha256").agg(F.sum("n").alias("n_all"), best("best").alias("best_all"))
        told = told.join(F.broadcast(joined.withColumn("cut", F.lit(True))), ["cut", "text_sha256"], "left")
    else:
        told = told.withColumns({"n_all": F.lit(None).cast("long"), "best_all": F.col("best")})
    whole_run = F.col("n_all").isNull()
    told = told.withColumn("keep_id", F.when(whole_run, F.col("best")).otherwise(F.col("best_all"))).withColumn("group_size", F.coalesce("n_all", "n"))
    return told.select(
        *[F.col("text" if c == text else f"row.`{c}`").alias(c) for c in names],
        "keep_id", "group_size", (F.col("last") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest", normal: Callable[[Column], Column] | None = None) -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    found = exact_duplicates(docs, text, doc_id, keep, normal)
    return found.filter("kept").select([c for c in docs.columns if c in found.columns])


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return exact_duplicates(docs, keep="largest", texts=False).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
