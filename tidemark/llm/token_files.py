"""Token files: independent zstandard frames, an index and a seek table with checksums.

A file holds, in this order:

* data frames, each compressed for itself. Decompressed, a frame is a count n,
  n document ids (int64), n lengths (uint32), then all ids (uint32), little endian;
* a skippable frame (magic 0x184D2A51) with the first document id, the document count and the
  number of the first id of each data frame;
* a skippable frame (magic 0x184D2A5E) with the seek table of zstandard's seekable format: for each
  frame before it the compressed size, the decompressed size and the low 32 bits of the XXH64 of the
  content, then the number of frames, a descriptor with the checksum flag, and magic 0x8F92EAB1.

A reader takes the last bytes, then only the frames that hold the documents it wants.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import encoder
from tidemark.llm.common import doc_ids, documents, new_folder, with_null_ids, written

INDEX_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A51, 0x184D2A5E, 0x8F92EAB1
#: Ids after which a frame ends; a longer document has a frame for itself.
FRAME_IDS = 65_536
#: Documents of a file, about; more shuffle partitions make smaller files.
FILE_DOCS = 100_000
INDEX = np.dtype([("first_doc", "<i8"), ("n_docs", "<i8"), ("first_id", "<i8")])
TABLE = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("checksum", "<u4")])


class Writer:
    """Writes one token file to an open stream, a frame at a time."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = 3):
        self.out, self.frame_ids = out, frame_ids
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.docs, self.waiting, self.n_waiting, self.n_ids = [], [], 0, 0
        self.index, self.table = [], []

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.frame_ids:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        plain = b"".join([
            struct.pack("<Q", len(self.docs)), np.array(self.docs, "<i8").tobytes(), np.array([len(x) for x in self.waiting], "<u4").tobytes(),
            *[np.ascontiguousarray(x, "<u4").tobytes() for x in self.waiting]])
        if len(plain) >= 1 << 32:
            raise ValueError("a frame of 4 GiB or more does not fit the seek table")
        packed = self.packer.compress(plain)
        self.out.write(packed)
        self.table.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.index.append((self.docs[0], len(self.docs), self.n_ids))
        self.n_ids += self.n_waiting
        self.docs, self.waiting, self.n_waiting = [], [], 0

    def close(self) -> int:
        """Write what is left, the index and the seek table; return the number of ids."""
        self.flush()
        index = np.array(self.index, INDEX).tobytes()
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array([*self.table, (8 + len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)], TABLE).tobytes()
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table) + 9) + table + struct.pack("<IBI", len(self.index) + 1, 0x80, SEEKABLE_MAGIC))
        return self.n_ids


class Document(NamedTuple):
    doc_id: int
    start: int
    ids: np.ndarray


class Reader:
    """Reads a token file; ``documents`` decompresses only the frames that it needs."""

    def __init__(self, file):
        self.file, end = file, file.size()
        tail = file.read_at(9, end - 9)
        n, flags, magic = struct.unpack("<IBI", tail)
        if magic != SEEKABLE_MAGIC or not flags & 0x80:
            raise ValueError("not a token file: no seek table with checksums")
        self.table = np.frombuffer(file.read_at(n * TABLE.itemsize, end - 9 - n * TABLE.itemsize), TABLE)
        self.at = np.concatenate([[0], np.cumsum(self.table["packed"], dtype="i8")])
        raw = file.read_at(int(self.table["packed"][-1]), int(self.at[-2]))
        self.index = np.frombuffer(raw[8:], INDEX)
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> Iterator[Document]:
        entry = self.table[k]
        plain = self.unpacker.decompress(self.file.read_at(int(entry["packed"]), int(self.at[k])), max_output_size=int(entry["plain"]))
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != int(entry["checksum"]):
            raise ValueError(f"frame {k}: checksum differs")
        (n,) = struct.unpack_from("<Q", plain)
        doc_ids, lengths = np.frombuffer(plain, "<i8", n, 8), np.frombuffer(plain, "<u4", n, 8 + 8 * n)
        ids, at, start = np.frombuffer(plain, "<u4", offset=8 + 12 * n), 0, int(self.index["first_id"][k])
        for d, m in zip(doc_ids.tolist(), lengths.tolist()):
            yield Document(d, start + at, ids[at:at + m])
            at += m

    def all(self) -> Iterator[Document]:
        for k in range(len(self.index)):
            yield from self.frame(k)

    def documents(self, wanted: set[int]) -> Iterator[Document]:
        """Documents by id; ids ascend through a file."""
        frames = set()
        for d in wanted:
            k = int(np.searchsorted(self.index["first_doc"], d, "left"))
            frames.update(range(max(0, k - 1), int(np.searchsorted(self.index["first_doc"], d, "right"))))
        for k in sorted(frames):
            yield from (x for x in self.frame(k) if x.doc_id in wanted)


def open_file(uri: str):
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, text: str = "text",
                      frame_ids: int = FRAME_IDS, file_docs: int = FILE_DOCS) -> DataFrame:
    """Encode ``docs`` into token files under ``folder``, a URI that all executors reach.

    Returns the manifest, one row for each file: path, first_doc, n_docs, n_ids,
    start (ids in files before it). Documents ascend by doc_id through the files (of one doc_id by a hash of the text, so that a doc_id, or
    null, that many rows share is spread over files too); Spark's range
    partitioning makes a file of each partition, with about ``file_docs`` documents at most. A null text is empty; a text of any
    length has a frame of its own, in which Spark's limit of 2 GB for a text leaves room. A task
    writes under a name of its own and renames when done, so a task that runs
    twice leaves one whole file.
    """
    whole = docs.select(doc_ids(), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // file_docs))
    ordered = whole.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end, writer, first, n = encoder(tokenizer), np.array([end_id], "<u4"), None, None, 0
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        temporary = f"{base}/_{uuid.uuid4().hex}"
        for frame in frames:
            for doc_id, t in zip(frame["doc_id"].tolist(), frame["text"]):
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    stream, first = fs.open_output_stream(temporary), doc_id
                    writer = Writer(stream, frame_ids)
                writer.add(doc_id, np.concatenate([enc.ids(t), end]))
                n += 1
        if writer is not None:
            n_ids = writer.close()
            stream.close()
            name = f"tokens-{TaskContext.get().partitionId():06d}.zst"
            fs.move(temporary, f"{base}/{name}")
            yield pd.DataFrame([(f"{folder}/{name}", first, n, n_ids)], columns=["path", "first_doc", "n_docs", "n_ids"])

    files = written(ordered.mapInPandas(write, "path string, first_doc long, n_docs long, n_ids long"), "token-files")
    before = Window.orderBy("first_doc", "path").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files of ``manifest``; a task reads a file at a time."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, start in zip(frame["path"], frame["start"].tolist()):
                with open_file(path) as file:
                    reader = Reader(file)
                    for k in range(len(reader.index)):
                        yield pd.DataFrame(
                            [(d.doc_id, start + d.start, len(d.ids), zlib.crc32(d.ids.tobytes())) for d in reader.frame(k)],
                            columns=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return with_null_ids(manifest.select("path", "start").repartition(n).mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(documents(spark, sf_dir), new_folder(spark, "tokens")))
