"""Versioned table state on plain Parquet: generations of files, and one pointer for each provider that says which count."""

from __future__ import annotations

import json
import random
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Threads of one process rename one at a time; local file systems check and rename in two steps.
_RENAME = threading.Lock()


class Conflict(RuntimeError):
    """Another publisher committed this provider's version first."""


@dataclass
class StateStore:
    """Tables under ``root``. A publish writes new files first, then commits all tables of a provider at once.

    The commit is a rename of one pointer file to the provider's next version,
    which fails if that exists; it lists every file folder of the provider's tables, so readers see
    all of a version or none, and providers never wait for each other. A table has one folder of open rows, which the
    provider's next snapshot replaces, and folders of closed rows that are added to until ``compact`` makes one of many.
    """

    spark: SparkSession
    root: str

    def _hadoop(self):
        jvm = self.spark.sparkContext._jvm
        path, conf = jvm.org.apache.hadoop.fs.Path(self.root), self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm, path.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf)

    def _names(self, folder: str) -> list[str]:
        jvm, fs, _ = self._hadoop()
        at = jvm.org.apache.hadoop.fs.Path(f"{self.root}/pointers{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def providers(self) -> list[str]:
        return [unquote(n[2:]) for n in self._names("") if n.startswith("p-")]

    def pointer(self, provider: str, back: int = 0) -> dict:
        """{"provider", "version", "tables": {name: {"open": folder or None, "closed": [folders]}}}: the newest version, or one ``back``."""
        jvm, fs, _ = self._hadoop()
        folder = f"/p-{quote(provider, safe='')}"
        versions = [n for n in self._names(folder) if n.startswith("v")][::-1]
        if back >= len(versions):
            return {"provider": provider, "version": 0, "tables": {}}
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{self.root}/pointers{folder}/{versions[back]}"))
        try:
            return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def read(self, name: str, schema: T.StructType, part: str | None = None, provider: str | None = None, at: dict | None = None) -> DataFrame:
        """The rows of a table, of its ``open`` or ``closed`` part, or none; of one ``provider`` only, if given; as of the pointer ``at``."""
        folders = []
        for p in [at] if at else map(self.pointer, self.providers() if provider is None else [provider]):
            table = p["tables"].get(name, {})
            folders += [*([table["open"]] if table.get("open") and part != "closed" else []), *(table.get("closed", []) if part != "open" else [])]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def write(self, name: str, df: DataFrame) -> str:
        folder = f"{self.root}/{name}/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(folder)
        return folder

    def write_each(self, name: str, df: DataFrame, providers: list[str]) -> dict[str, str | None]:
        """Each provider's folder of one write, or None where it has no rows; ``df`` has a column provider."""
        jvm, fs, _ = self._hadoop()
        folder = f"{self.root}/{name}/{uuid.uuid4().hex}"
        number = F.array_position(F.array(*[F.lit(p) for p in providers]), F.col("provider"))
        df.withColumn("_p", number).write.partitionBy("_p").option("compression", "zstd").parquet(folder)
        each = {p: f"{folder}/_p={k}" for k, p in enumerate(providers, 1)}
        return {p: f if fs.exists(jvm.org.apache.hadoop.fs.Path(f)) else None for p, f in each.items()}

    def retried(self, attempt: Callable[[], dict | None], tries: int = 50) -> dict | None:
        """``attempt`` until it meets no conflict; the last one is raised."""
        for k in range(tries):
            try:
                return attempt()
            except Conflict:
                if k == tries - 1:
                    raise
                time.sleep(random.uniform(0.01, 0.05 * (k + 1)))

    def append(self, provider: str, added: dict[str, DataFrame]) -> dict:
        """Add rows to tables in a commit of their own; another commit in between does no harm."""
        folders = {name: self.write(name, df) for name, df in added.items()}
        return self.retried(lambda: self.commit(self.pointer(provider), added=folders))

    def rewrite(self, name: str, schema: T.StructType, provider: str, change: Callable[[DataFrame], DataFrame], fan_in: int = 1) -> dict | None:
        """Replace the closed rows of a provider's table by ``change`` of them, if they are in ``fan_in`` folders or more."""

        def attempt() -> dict | None:
            base = self.pointer(provider)
            folders = base["tables"].get(name, {}).get("closed", [])
            if len(folders) < fan_in:
                return None
            return self.commit(base, closed={name: [self.write(name, change(self.spark.read.schema(schema).parquet(*folders)))]})

        return self.retried(attempt)

    def compact(self, name: str, schema: T.StructType, provider: str, fan_in: int = 16) -> bool:
        """Rewrite the closed part of a table as one folder once it has ``fan_in`` of them."""
        return self.rewrite(name, schema, provider, lambda df: df, fan_in) is not None

    def commit(self, base: dict, replaced: dict[str, str | None] | None = None, added: dict[str, str | None] | None = None, closed: dict[str, list[str]] | None = None) -> dict:
        """The provider's next version after ``base``: ``replaced`` open parts, folders ``added`` to closed parts, whole new ``closed`` parts; None is no rows."""
        tables = {n: dict(t) for n, t in base["tables"].items()}
        for name, folders in (closed or {}).items():
            tables[name] = {**tables.get(name, {}), "closed": [f for f in folders if f]}
        for name, folder in (replaced or {}).items():
            tables[name] = {**tables.get(name, {}), "open": folder}
        for name, folder in (added or {}).items():
            if folder is None:
                continue
            tables[name] = {**tables.get(name, {}), "closed": [*tables.get(name, {}).get("closed", []), folder]}
        new = {"provider": base["provider"], "version": base["version"] + 1, "tables": tables}
        jvm, fs, context = self._hadoop()
        path, folder = jvm.org.apache.hadoop.fs.Path, f"{self.root}/pointers/p-{quote(base['provider'], safe='')}"
        temporary = path(f"{folder}/_{uuid.uuid4().hex}")
        stream = fs.create(temporary, False)
        stream.write(bytearray(json.dumps(new).encode()))
        stream.close()
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            with _RENAME:
                context.rename(temporary, path(f"{folder}/v{new['version']:010d}"), none)
        except Exception as e:
            fs.delete(temporary, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"{base['provider']}: version {new['version']}") from e
            raise
        return new
