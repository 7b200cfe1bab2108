"""Phrase collocations by Toivonen's mining: a sample proposes, a full pass counts, failures of the border are followed up."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, documents, written

#: Words of the longest phrase.
LONGEST = 4
#: Share of the pieces that the sample takes.
SAMPLE = 0.25
#: Bytes of text that a worker splits at once.
CHUNK = 2 << 20
#: Bits of a filter at least, at most, and for each proposed phrase.
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 16, 1 << 28, 16
#: Counts up to so many rows and bytes are broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 16 << 20
#: Parts into which a language's candidates are ranked first.
SALT = 64

COUNTS = "lang string, n int, phrase string, c long"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Filters:
    """For phrases of 1, 2, ... words: a bit array that holds the keys of all wanted ones, and by chance some others.

    Whatever the arrays hold counts as wanted, so chance costs time, never results; their size is bounded, however many phrases there are.
    """

    bits: list[np.ndarray]

    def has(self, n: int, key: np.ndarray) -> np.ndarray:
        array = self.bits[n - 1]
        mask = np.uint64(8 * len(array) - 1)
        found = np.ones(len(key), bool)
        for p in ((key >> np.uint64(2)) & mask, (key >> np.uint64(32)) & mask):
            found &= (array[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _chunks(texts: pa.StringArray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, ends of rows and the first row of runs of about ``CHUNK`` bytes, cut between pieces only.

    A text longer than a chunk is cut where a piece ends, so memory is bounded by the longest piece.
    """
    if not len(texts):
        return
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    start = 0
    while start < len(data):
        stop = min(len(data), start + CHUNK)
        while stop < len(data):
            row_end = int(offsets[np.searchsorted(offsets, stop)])
            near = min(row_end, stop + CHUNK)
            breaks = np.flatnonzero(_KIND[data[stop:near]] == _BREAK)
            if len(breaks) or near == row_end:
                stop = stop + int(breaks[0]) if len(breaks) else row_end
                break
            stop = near
        first, last = int(np.searchsorted(offsets, start, "right")) - 1, int(np.searchsorted(offsets, stop, "left"))
        yield data[start:stop], np.minimum(offsets[first + 1:last + 1], stop) - start, first
        start = stop


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lower-cased words, their rows, and which stand in one piece with the next word."""
    kind = _KIND[data]
    word = kind == _WORD
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    at = ends[ends < len(data)]
    begins[at] |= word[at]
    first = np.flatnonzero(begins)
    place = np.cumsum(word, dtype=np.int32)[first] - 1
    kept = _LOWER[data[word]]
    words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.append(place, len(kept)).astype(np.int32)), pa.py_buffer(kept)])
    row, piece = np.searchsorted(ends, first, "right"), np.cumsum(kind == _BREAK, dtype=np.int32)[first]
    return words, row, (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])


def _hashes(values: pa.Array) -> np.ndarray:
    """64 bits of each value's bytes and their places, by one sum for each value."""
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    sizes = np.diff(offsets)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    place = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(data + _GOLDEN * (place + 1).astype(np.uint64)))])
    return _mix(sums[offsets[1:] - offsets[0]] - sums[offsets[:-1] - offsets[0]] + sizes.astype(np.uint64))


def _runs(words: pa.DictionaryArray, linked: np.ndarray, lang: np.ndarray, langs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For n = 1, 2, ...: the first words of all runs of n words in a piece, and their keys: 62 bits of a hash with the language, and n - 1."""
    one = _mix(_hashes(words.dictionary)[words.indices.to_numpy()] ^ langs[lang])
    at, key = np.arange(len(one)), one
    for n in range(1, LONGEST + 1):
        if n > 1:
            on = at < len(one) - n + 1
            on[on] = linked[at[on] + n - 2]
            at = at[on]
            key = _mix(key[on] * np.uint64(3) + one[at + n - 1] + np.uint64(n))
        key = key & ~np.uint64(3) | np.uint64(n - 1)
        yield n, at, key


def _candidates(words: pa.DictionaryArray, linked: np.ndarray, lang: np.ndarray, langs: np.ndarray, new: Filters | None, old: Filters | None, levels: tuple[int, ...]) -> Iterator[np.ndarray]:
    """Keys of a chunk's phrases, once for each time, of those whose first and last words but one the new filters let in, and not the old ones too."""
    size = len(words)
    for n, at, key in _runs(words, linked, lang, langs):
        wanted, told = np.ones(len(at), bool), np.full(len(at), n > 1 and old is not None)
        if n > 1:
            wanted = let_in[at] & let_in[at + 1]
            told &= had[at] & had[at + 1]
        if n in levels:
            yield key[wanted & ~told]
        if n == max(levels):
            return
        # By first word: may this run be part of a longer candidate?
        let_in, had = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        let_in[at] = wanted & new.has(n, key)
        if old is not None:
            had[at] = (told if n > 1 else True) & old.has(n, key)


def _lang(batch: pa.RecordBatch) -> pa.DictionaryArray:
    return batch.column("lang").cast(pa.binary()).dictionary_encode()


def _each_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DictionaryArray, np.ndarray, np.ndarray, pa.Array]]:
    """Words, links, language codes of words, and languages of each chunk."""
    for batch in batches:
        lang = _lang(batch)
        for data, ends, first in _chunks(batch.column("text")):
            words, row, linked = _words(data, ends)
            if len(words):
                yield words.dictionary_encode(), linked, lang.indices.to_numpy()[first + row], lang.dictionary


def _salted(langs: pa.Array) -> np.ndarray:
    return _mix(_hashes(langs) + _GOLDEN)


def _counting(new, old, levels: tuple[int, ...]) -> Callable:
    """Counts of keys; ``new`` and ``old`` are broadcast filters or None."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, linked, lang, langs in _each_chunk(batches):
            for keys in _candidates(words, linked, lang, _salted(langs), new and new.value, old and old.value, levels):
                found, counts = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "c"])

    return count


def _exact(frequent) -> Callable:
    """Counts of whole phrases whose keys ``frequent`` holds, and of all words of each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, linked, lang, langs in _each_chunk(batches):
            texts, codes = words.dictionary, words.indices.to_numpy()
            total = np.bincount(lang, minlength=len(langs))
            yield _counted_rows(langs, 0, pa.array(np.arange(len(langs))), pa.array([b""] * len(langs), pa.binary()), total)
            for n, at, key in _runs(words, linked, lang, _salted(langs)):
                at = at[frequent.value.has(n, key)]
                # Numbers that stand for language and words, so equal ones are equal phrases.
                same = lang[at].astype(np.int64) * len(texts) + codes[at]
                for k in range(1, n):
                    same = np.unique(same, return_inverse=True)[1] * len(texts) + codes[at + k]
                _, first, counts = np.unique(same, return_index=True, return_counts=True)
                at = at[first]
                phrases = pc.binary_join_element_wise(*[texts.take(pa.array(codes[at + k])) for k in range(n)], b" ")
                yield _counted_rows(langs, n, pa.array(lang[at]), phrases, counts)

    return count


def _counted_rows(langs: pa.Array, n: int, own: pa.Array, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [langs.take(own).cast(pa.string()), pa.array(np.full(len(own), n, np.int32)), phrases.cast(pa.string()), pa.array(counts.astype(np.int64))], names=["lang", "n", "phrase", "c"])


def _sampling(share: float) -> Callable:
    """Rows with a random share of their pieces, the same ones in a task that is run again."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            lang = batch.column("lang")
            for data, ends, first in _chunks(batch.column("text")):
                cut = _KIND[data] == _BREAK
                cut[0] = True
                cut[ends[ends < len(data)]] = True
                piece = np.cumsum(cut, dtype=np.int32) - 1
                kept = (random.random(int(piece[-1]) + 1) < share)[piece]
                stops = np.cumsum(kept, dtype=np.int32)[ends[ends > 0] - 1]
                stops = np.concatenate([np.zeros(int((ends == 0).sum()) + 1, np.int32), stops])
                text = pa.StringArray.from_buffers(len(ends), pa.py_buffer(stops), pa.py_buffer(data[kept]))
                yield pa.RecordBatch.from_arrays([lang.slice(first, len(ends)), text], names=["lang", "text"])

    return sample


def _keys(texts: DataFrame, least: int, new: Filters | None, old: Filters | None, levels: tuple[int, ...]) -> DataFrame:
    """(key, c) of candidates that occur ``least`` times or more. Phrases that share a key are counted together, so none is lost."""
    sc = texts.sparkSession.sparkContext
    new, old = [f and sc.broadcast(f) for f in (new, old)]
    return texts.mapInArrow(_counting(new, old, levels), "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).filter(F.col("c") >= least)


def _positions(key: Column, bits: int) -> list[Column]:
    mask = F.lit(bits - 1).cast("long")
    return [F.shiftrightunsigned(key, k).bitwiseAND(mask) for k in (2, 32)]


def _filled(keys: DataFrame, n: int, most_bits: int, before: np.ndarray | None = None) -> np.ndarray:
    """A filter that holds the keys of n words, and what ``before`` holds; its size is that of ``before``, or by their number.

    Bits are put together by Spark; words of 64 bits of one filter, bounded by ``most_bits``, reach the driver.
    """
    own = keys.filter(F.col("key").bitwiseAND(F.lit(3).cast("long")) == n - 1)
    bits = 8 * len(before) if before is not None else LEAST_BITS
    if before is None:
        wanted = BITS_EACH * own.count()
        while bits < wanted and bits < most_bits:
            bits *= 2
    at = own.select(F.explode(F.array(*_positions(F.col("key"), bits))).alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    found = at.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(one).alias("b")).toArrow()
    words = np.zeros(bits // 64, np.uint64) if before is None else before.view(np.uint64).copy()
    words[found.column("word").to_numpy()] |= found.column("b").to_numpy().view(np.uint64)
    return words.view(np.uint8)


def _missing(frequent: DataFrame, filters: Filters) -> DataFrame:
    """Frequent keys that can begin longer phrases and that the filters lack: failures of the border."""
    held = frequent.sparkSession.sparkContext.broadcast(filters)

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            n, has = key & np.uint64(3), np.ones(len(key), bool)
            for k in range(1, LONGEST):
                has[n == k - 1] = held.value.has(k, key[n == k - 1])
            yield batch.filter(pa.array(~has))

    return frequent.select("key").mapInArrow(lacking, "key long")


def frequent_phrases(texts: DataFrame, least: int, share: float = SAMPLE, most_bits: int = MOST_BITS) -> DataFrame:
    """(lang, n, phrase, c): every phrase of up to four words that occurs ``least`` times or more in its lang, exactly; n = 0: all words.

    ``texts`` has lang and text, without nulls. A random share of all pieces, so a sample that grows with the input, is mined level by level at a
    threshold lowered by two standard deviations, and proposes phrases. One pass over all texts counts every word and every phrase
    whose first and last words but one are proposed: the proposed ones and their negative border. Where a frequent phrase
    is not proposed, the border has failed: it is added, and a further pass counts what this lets in and no pass has counted yet, until
    nothing is added. Each pass settles one more length, so there are four at most. The sample decides about time only.

    These passes count phrases by keys of 64 bits, which are short to shuffle; phrases that share a key count together, so its count is an upper
    bound, and all frequent phrases are among the frequent keys. A last pass counts those by their words.
    """
    sc, levels = texts.sparkSession.sparkContext, tuple(range(1, LONGEST + 1))
    with Scratch(texts.sparkSession) as scratch:
        sample = scratch.written(texts.mapInArrow(_sampling(share), "lang string, text string"), "sample")
        lowered = max(1, ceil(least * share - 2 * sqrt(least * share * (1 - share))))
        filters = Filters([])
        for n in levels[:-1]:
            proposed = scratch.written(_keys(sample, lowered, filters, None, (n,)).select("key"), "proposed")
            filters = Filters([*filters.bits, _filled(proposed, n, most_bits)])
            scratch.drop(proposed)
        scratch.drop(sample)
        found = scratch.written(_keys(texts, least, filters, None, levels), "keys")
        every = found
        while True:
            failed = scratch.written(_missing(found, filters), "failures")
            if failed.isEmpty():
                break
            more = Filters([_filled(failed, n, most_bits, filters.bits[n - 1]) for n in levels[:-1]])
            found = scratch.written(_keys(texts, least, more, filters, levels[1:]), "keys")
            every, filters = every.unionAll(found), more
        frequent = sc.broadcast(Filters([_filled(every, n, most_bits) for n in levels]))
        counts = texts.mapInArrow(_exact(frequent), COUNTS).groupBy("lang", "n", "phrase").agg(F.sum("c").alias("c"))
        return written(counts.filter((F.col("c") >= least) | (F.col("n") == 0)), "phrases")


def _small(counts: DataFrame) -> bool:
    row = counts.agg(F.count("*").alias("n"), F.sum(F.octet_length("phrase") + F.octet_length("lang")).alias("b")).first()
    return row["n"] <= BROADCAST_ROWS and (row["b"] or 0) <= BROADCAST_BYTES


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, inside: int = 80, top: int = 2000, share: float = SAMPLE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each lang's best ``top`` phrases of two to four words.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and those into words at spaces and tabs. a = f(phrase) is
    at least ``least``; the lowest-scoring cut, floor(2000000 a / (l + r)), gives l and r, ties to the shortest first part. A
    phrase goes if a longer one that contains it has ``inside`` percent of its count or more. n counts all words of the lang. Order: score
    and a descending, phrase ascending by bytes. A null text is empty, a null lang is ``und``; repeated rows count each time;
    texts of any length are counted whole, cut in a worker between pieces only. Other columns are ignored. No words, no rows.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    every = frequent_phrases(texts, least, share)
    counts = every.filter("n > 0").select("lang", "n", "phrase", F.col("c").alias("a"))
    known = F.broadcast(counts.select("lang", "phrase", "a")) if _small(counts) else counts.select("lang", "phrase", "a")
    phrases = counts.filter("n > 1").withColumn("w", F.split("phrase", " "))
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("n") - F.col("k")).alias("right"))
    cut = (
        cut.join(known.select(F.col("lang"), F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
        .join(known.select(F.col("lang"), F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
        .withColumn("score", F.expr("(cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    )
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    within = (
        phrases.filter("n > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("n") - 1)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("size") + 1)))
        .select("lang", part(F.col("start"), F.col("size")).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    kept = (
        best.join(within, ["lang", "phrase"], "left")
        .filter(F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * inside))
        .select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    )
    # Ranked in parts first, so that no task holds all candidates of a lang.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALT))).orderBy(*order)
    kept = kept.withColumn("place", F.row_number().over(parted)).filter(F.col("place") <= top).drop("place")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = every.filter("n = 0").select("lang", F.col("c").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir).select("lang", "text"))
