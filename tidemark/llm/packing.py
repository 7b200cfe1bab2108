"""Bounded-space packing of token sequences into windows."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import encoder
from tidemark.llm.common import doc_ids, documents, with_null_ids, written

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, full boolean, offset long"


class OpenWindows:
    """At most ``n_open`` windows of ``size`` tokens; items go where least room remains.

    ``add`` returns the windows it closes: one that is full, and the fullest one
    when an item fits in none and all places are taken. A window is a list of
    items, each a list whose first entry is its length.
    """

    def __init__(self, size: int, n_open: int):
        self.size, self.n_open, self.made = size, n_open, 0
        #: (room, serial number, items), by room.
        self.open: list[tuple[int, int, list]] = []

    def add(self, item: list) -> list[list]:
        at, closed = bisect.bisect_left(self.open, (item[0],)), []
        if at < len(self.open):
            room, serial, items = self.open.pop(at)
        else:
            if len(self.open) >= self.n_open:
                closed.append(self.open.pop(0)[2])
            self.made += 1
            room, serial, items = self.size, self.made, []
        items.append(item)
        if room == item[0]:
            closed.append(items)
        else:
            bisect.insort(self.open, (room - item[0], serial, items))
        return closed

    def rest(self) -> list[list]:
        return [w[2] for w in self.open]


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", size: int = 2048, end_id: int = 1, n_open: int = 64,
         text: str = "text", fan_in: int = 64, keep_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document is its ids and ``end_id``; a null text is empty, so each document
    has a token. Documents of more than ``size`` tokens fill whole windows first; what
    remains of them, like every shorter document, is never cut and goes by best
    fit to one of ``n_open`` open windows of its partition. Windows still open
    when partitions end are merged, again by best fit, ``fan_in``
    partitions at a time until one such group is left, so that no task gets more than
    ``n_open * fan_in`` windows. Rows that repeat a doc_id are packed each for itself.
    """
    columns = PIECE + (", ids array<int>" if keep_ids else "")
    names = [x.split()[0] for x in columns.split(", ")]

    def in_partition(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, base, made = encoder(tokenizer), TaskContext.get().partitionId() << 40, 0
        windows = OpenWindows(size, n_open)

        def rows(window: list, full: bool) -> list[tuple]:
            nonlocal made
            made, at, out = made + 1, 0, []
            for item in window:
                out.append((*item[1:3], item[0], *item[3:5], base + made, full, at, *item[5:]))
                at += item[0]
            return out

        for frame in frames:
            out = []
            for doc_id, t in zip(frame["doc_id"], frame["text"]):
                ids = np.append(enc.ids(t), np.uint32(end_id)).astype("<u4")
                raw = memoryview(ids.tobytes())
                for start in range(0, len(ids), size):
                    n = min(size, len(ids) - start)
                    item = [n, doc_id, start, zlib.crc32(raw[4 * start:4 * (start + n)]), len(ids), *([ids[start:start + n].tolist()] if keep_ids else ())]
                    for w in [[item]] if n == size else windows.add(item):
                        out += rows(w, True)
            if out:
                yield pd.DataFrame(out, columns=names)
        if left := [r for w in windows.rest() for r in rows(w, False)]:
            yield pd.DataFrame(left, columns=names)

    whole = docs.select(doc_ids(), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pieces = written(whole.mapInPandas(in_partition, columns), "pieces")
    return _merged(pieces, names, size, fan_in)


def _merged(pieces: DataFrame, names: list[str], size: int, fan_in: int) -> DataFrame:
    """Merge the windows that partitions left open; level by level, ``fan_in`` partitions in a group."""
    done = pieces.filter("full")
    open_ = pieces.filter("not full")
    top = open_.agg(F.max(F.shiftright("window", 40))).first()[0]
    last = (top or 0) + 1

    def best_fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["window", "offset"], kind="stable")
        total = frame.groupby("window")["length"].sum().sort_values(ascending=False, kind="stable")
        windows = OpenWindows(size, len(total))
        closed = [w for n, k in zip(total, total.index) for w in windows.add([int(n), k])] + windows.rest()
        base, home = {}, {}
        for w in closed:
            at = 0
            for n, k in w:
                base[k], home[k] = at, w[0][1]
                at += n
        frame["offset"] += frame["window"].map(base)
        frame["window"] = frame["window"].map(home)
        return frame[names + ["level"]]

    span = 1
    while span < last:
        # Windows that hold more than half of their room cannot pair with each other;
        # a level cuts the others to half or less, so groups stay small.
        span *= fan_in
        level = open_.withColumn("level", F.floor(F.shiftright("window", 40) / span).cast("long"))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in open_.schema) + ", level long"
        merged = level.groupBy("level").applyInPandas(best_fit, schema).drop("level")
        if span < last:
            full = F.sum("length").over(Window.partitionBy("window"))
            merged = written(merged.withColumn("_n", full), "windows")
            done = done.unionByName(merged.filter(F.col("_n") > size // 2).drop("_n"))
            merged = merged.filter(F.col("_n") <= size // 2).drop("_n")
        open_ = merged
    return with_null_ids(done.unionByName(open_)).withColumnRenamed("window", "sequence_id").drop("full")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
