"""Size-tiered compaction of shards under a versioned manifest."""

from __future__ import annotations

import functools
import json
import math
import random
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import documents, new_folder

#: So often a change is put on top of a newer version before it is given up.
TRIES = 50


@dataclass
class ShardStore:
    """Immutable Parquet shards under ``root`` and manifests that say which of them count.

    A write first makes files under a fresh name, then commits a manifest with
    the next version number by a rename that fails if that version exists. So
    readers see whole versions only, and of two writers one comes second: it puts its change on top of the newest
    version, with the files that it has. Arrivals always can; a merge can as long as
    the version still lists all it was made of, else another compaction was first and that merge is left out. Files of lost or overtaken writes are never listed. Manifests hold a path and a size for each
    shard, and the schema: the union of all arrivals' columns. A column that a shard lacks is null in its rows, before
    and after compaction; an arrival that gives a column another type is refused. Rows may repeat, hold nulls anywhere
    and texts of any length, and come back as they came; an arrival without rows adds its columns only. Rows never pass through the driver.
    """

    spark: SparkSession
    root: str
    #: Files from half this size on are finished.
    target_bytes: int = 128 << 20
    #: So many runs of one tier are merged; sizes within a tier differ by less than this factor.
    fan_in: int = 4
    smallest_bytes: int = 1 << 20
    codec: str = "zstd"
    _java: dict = field(default_factory=dict, repr=False)

    def _fs(self):
        if not self._java:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(self.root)
            conf = self.spark.sparkContext._jsc.hadoopConfiguration()
            self._java.update(jvm=jvm, fs=path.getFileSystem(conf), context=jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf), path=jvm.org.apache.hadoop.fs.Path)
        return self._java

    def versions(self) -> list[int]:
        j = self._fs()
        folder = j["path"](f"{self.root}/manifests")
        if not j["fs"].exists(folder):
            return []
        names = [s.getPath().getName() for s in j["fs"].listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """{"version", "schema", "shards": [{"path", "bytes", "merged"}]}; version 0 is empty."""
        version = max(self.versions(), default=0) if version is None else version
        if version == 0:
            return {"version": 0, "schema": T.StructType().jsonValue(), "shards": []}
        j = self._fs()
        stream = j["fs"].open(j["path"](f"{self.root}/manifests/v{version:010d}.json"))
        try:
            return json.loads(bytes(j["jvm"].org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def commit(self, base: dict, shards: list[dict], schema: T.StructType | None = None) -> dict:
        j, new = self._fs(), {"version": base["version"] + 1, "schema": schema.jsonValue() if schema else base["schema"], "shards": shards}
        temporary = j["path"](f"{self.root}/manifests/_{uuid.uuid4().hex}")
        stream = j["fs"].create(temporary, False)
        stream.write(bytearray(json.dumps(new).encode()))
        stream.close()
        none = self.spark.sparkContext._gateway.new_array(j["jvm"].org.apache.hadoop.fs.Options.Rename, 0)
        try:
            j["context"].rename(temporary, j["path"](f"{self.root}/manifests/v{new['version']:010d}.json"), none)
        except Exception as e:
            j["fs"].delete(temporary, False)
            if "FileAlreadyExists" in str(e):
                raise CommitConflict(f"version {new['version']} exists") from e
            raise
        return new

    def _rebased(self, base: dict, change: Callable[[dict], tuple[list[dict], T.StructType | None] | None]) -> dict:
        """Commit what ``change`` makes of ``base``, or of the newest manifest where others came first; with None there is nothing to commit."""
        for k in range(TRIES):
            new = change(base)
            if new is None:
                return base
            try:
                return self.commit(base, *new)
            except CommitConflict:
                time.sleep(random.uniform(0, 0.02 * 2 ** min(k, 6)))
                base = self.manifest()
        raise CommitConflict(f"{TRIES} versions came first")

    def _write(self, df: DataFrame, merged: bool) -> list[dict]:
        """New shards with the rows of ``df``, one for each partition that has any."""
        j, folder = self._fs(), f"{self.root}/data/{uuid.uuid4().hex}"
        df.write.option("compression", self.codec).parquet(folder)
        files = [s for s in j["fs"].listStatus(j["path"](folder)) if s.getPath().getName().startswith("part-")]
        return [{"path": s.getPath().toString(), "bytes": int(s.getLen()), "merged": merged} for s in files]

    def append(self, rows: DataFrame) -> dict:
        """Add one arrival as small shards: what each task has, without a shuffle."""
        base = self.manifest()
        union_schema(self.schema(base), rows.schema)
        new = self._write(rows, False)
        return self._rebased(base, lambda m: (m["shards"] + new, union_schema(self.schema(m), rows.schema)))

    def tier(self, size: int) -> int:
        return max(0, math.floor(math.log(max(size, 1) / self.smallest_bytes, self.fan_in))) if size > self.smallest_bytes else 0

    def due(self, shards: list[dict]) -> list[list[dict]]:
        """Runs of similar size to merge: each tier with ``fan_in`` unfinished shards or more."""
        tiers: dict[int, list[dict]] = {}
        for s in shards:
            if 2 * s["bytes"] < self.target_bytes:
                tiers.setdefault(self.tier(s["bytes"]), []).append(s)
        return [t for _, t in sorted(tiers.items()) if len(t) >= self.fan_in]

    def compact(self) -> dict:
        """Merge tiers until none is due, and commit each step.

        A tier is one job: Spark reads its shards, joins whole partitions
        (``coalesce``, no shuffle) and writes files of at most about the target size. The number of jobs is that
        of the tiers, a logarithm of the target size.
        """
        base = self.manifest()
        while runs := self.due(base["shards"]):
            schema, swaps = self.schema(base), []
            for run in runs:
                total = sum(s["bytes"] for s in run)
                rows = self.spark.read.schema(schema).parquet(*[s["path"] for s in run]).coalesce(math.ceil(total / self.target_bytes))
                swaps.append(({s["path"] for s in run}, self._write(rows, True)))
            if sum(len(made) for _, made in swaps) >= sum(len(gone) for gone, _ in swaps):  # a scan may keep more partitions than asked for
                return base
            base = self._rebased(base, functools.partial(swapped, swaps=swaps))
        return base

    def schema(self, manifest: dict) -> T.StructType:
        return T.StructType.fromJson(manifest["schema"])

    def read(self, version: int | None = None, merged: bool | None = None) -> DataFrame:
        """Rows of a version; only those of shards that compaction made, or of those that it did not, with ``merged``."""
        last = self.manifest(version)
        paths = [s["path"] for s in last["shards"] if merged in (None, s["merged"])]
        schema = self.schema(last)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)


def union_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Columns of ``a``, then new ones of ``b``, all of them nullable; names that differ in case only, or one name of two types, are refused."""
    kinds = {f.name: f.dataType for f in a.fields}
    for f in b.fields:
        if kinds.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is {kinds[f.name].simpleString()}, not {f.dataType.simpleString()}")
    if len({n.lower() for n in kinds}) < len(kinds):
        raise ValueError("columns whose names differ in case only")
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def swapped(manifest: dict, swaps: list[tuple[set[str], list[dict]]]) -> tuple[list[dict], None] | None:
    """The shards of ``manifest`` with each merge in place of what it was made of, where all of that is still listed; None if no merge is left."""
    listed = {s["path"] for s in manifest["shards"]}
    left = [(gone, made) for gone, made in swaps if gone <= listed]
    replaced = {path for gone, _ in left for path in gone}
    return ([s for s in manifest["shards"] if s["path"] not in replaced] + [s for _, made in left for s in made], None) if left else None


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


def op8_sharding(spark: SparkSession, sf_dir: str, arrivals: int = 6) -> DataFrame:
    """Let the documents arrive in parts, compact after each, and read every row back from the last version.

    The parts, by a hash of the doc_id, make up the whole table. doc_id, version, whether its shard was merged, bytes and crc32 of its text.
    """
    store, docs = ShardStore(spark, new_folder(spark, "shards")), documents(spark, sf_dir)
    for k in range(arrivals):
        store.append(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(arrivals)) == k))
        last = store.compact()
    rows = store.read(merged=True).withColumn("merged", F.lit(True)).unionAll(store.read(merged=False).withColumn("merged", F.lit(False)))
    return rows.select(
        "doc_id", F.lit(last["version"]).alias("version"), "merged",
        F.octet_length("text").cast("long").alias("n_bytes"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
