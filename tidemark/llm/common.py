"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as the contracts define it: space, and tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


#: Stands for a null doc_id where pandas would turn the column into floats, and sorts first.
NO_ID = -(2**63)


def doc_ids() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID).cast("long")).alias("doc_id")


def with_null_ids(df: DataFrame) -> DataFrame:
    """Turn the mark of ``doc_ids`` back into null."""
    return df.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID).cast("long")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``. In local mode, where the
    driver is the only machine, a fresh temporary folder stands in.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, and lost executors lose nothing."""
    return _write(df, name)[0]


class Scratch:
    """Tables in the shared folder that are deleted once they are spent, at the latest when the block ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Scratch:
        return self

    def written(self, df: DataFrame, name: str) -> DataFrame:
        table, path = _write(df, name)
        self.tables[id(table)] = (table, path)
        return table

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            _, path = self.tables.pop(id(t))
            jvm = self.spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def __exit__(self, *_) -> None:
        self.drop(*[t for t, _ in self.tables.values()])


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs without white space."""
    return F.array_remove(F.split(text, SPACES, -1), "")


def power_bounds(ids: DataFrame, col: str, rows_per_bucket: int, most: int = 65_536) -> list[int]:
    """Ascending upper bounds that cut ``col`` into 2^k ranges of about equal row counts.

    One aggregation makes them; at most ``most`` - 1 numbers reach the driver,
    whatever the table's size.
    """
    n = ids.count()
    buckets = 1
    while buckets * rows_per_bucket < n and buckets < most:
        buckets *= 2
    if buckets == 1:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    row = ids.agg(F.percentile_approx(col, shares, max(10_000, 4 * buckets)).alias("b")).first()
    return list(row["b"] or [])


def with_range_bucket(df: DataFrame, col: str, bounds: list, out: str = "bucket", kind: str = "bigint") -> DataFrame:
    """Add the index of the range that holds ``col``, by a binary search in unrolled steps."""
    df = df.withColumn(out, F.lit(0))
    if not bounds:
        return df
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast(f"array<{kind}>")
    step = (len(bounds) + 1) // 2
    while step:
        at = F.element_at(table, F.col(out) + step)
        df = df.withColumn(out, F.when(F.col(col) >= at, F.col(out) + step).otherwise(F.col(out)))
        step //= 2
    return df
