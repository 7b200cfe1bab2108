"""A list published in the order of its pages, so that a page is read from one file."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.catalogue import keyset_page


def publish(items: DataFrame, path: str, files: int, date: str = "begin_date", key: str = "cruise_id") -> None:
    """Write ``items`` under ``path`` in about ``files`` ranges of (date, key), each sorted, and a directory with each file's last pair and rows."""
    items.repartitionByRange(files, date, key).sortWithinPartitions(date, key).write.parquet(f"{path}/rows")
    rows = items.sparkSession.read.schema(items.schema).parquet(f"{path}/rows")
    rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max(F.struct(F.col(date).alias("date"), F.col(key).alias("key"))).alias("last"), F.count("*").alias("n")).coalesce(1).write.parquet(f"{path}/directory")


@dataclass
class Pages:
    """Pages of a published list. The directory, one row for each file, is held by the driver."""

    spark: SparkSession
    path: str
    date: str = "begin_date"
    key: str = "cruise_id"

    def __post_init__(self):
        rows = self.spark.read.parquet(f"{self.path}/directory").orderBy("last").collect()
        self.lasts = [(r["last"]["date"].isoformat(), r["last"]["key"].encode()) for r in rows]
        self.files, self.schema = [r["file"] for r in rows], self.spark.read.parquet(f"{self.path}/rows").schema

    def page(self, cursor: tuple[str, str] | None, limit: int) -> tuple[list[Row], tuple[str, str] | None]:
        """At most ``limit`` rows after ``cursor``, and the next cursor, None on the last page.

        The file that holds the next row is found by its last pair; further files are read only where a page reaches into them.
        """
        limit = max(1, min(limit, 100))
        at = bisect_right(self.lasts, (cursor[0], cursor[1].encode())) if cursor else 0
        rows: list[Row] = []
        while at < len(self.files) and len(rows) <= limit:
            one = self.spark.read.schema(self.schema).parquet(self.files[at])
            rows += keyset_page(one, cursor, limit, self.date, self.key).collect()[:limit + 1 - len(rows)]
            at += 1
        more = len(rows) > limit
        rows = rows[:limit]
        return rows, (rows[-1][self.date].isoformat(), rows[-1][self.key]) if more else None
