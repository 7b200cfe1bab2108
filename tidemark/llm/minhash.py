"""Near duplicates: ProbMinHash signatures of weighted word shingles, banding, exact verification.

One measure throughout: the probability Jaccard similarity of two texts' shingle counts,

    J(x, y) = sum over shared i of 1 / sum over all j of max(x_j / x_i, y_j / y_i),

which is the share of registers in which two ProbMinHash signatures agree. It
does not change when a text is repeated as a whole, and where no shingle is repeated it is
the Jaccard similarity of shingle sets. Bands, sketches and the exact test all follow it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, documents, written

SHINGLE = 5
#: A pair of similarity 0.8 shares a band with a probability of 0.9994, one of 0.4 with 0.03.
BANDS, ROWS = 40, 8
#: A sketch has the two lowest bits of each register, packed in bigints.
REGISTERS = BANDS * ROWS
#: Words that are worked on at once in a Python worker.
BATCH_WORDS = 150_000
#: Texts whose copies a signing task recognises; more of them only cost time.
SEEN = 200_000
#: Ids up to so many are broadcast to pick rows; beyond, rows are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: A block of a bucket; blocks of a family hold about so many rows and shingles.
BUCKET_ROWS, FAMILY_ROWS, FAMILY_SHINGLES = 2048, 512, 200_000
#: Shingles that are compared at once.
COLUMNS = 4096

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a document's word hashes and their counts; a shorter document is one shingle."""
    n = min(SHINGLE, len(words))
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    sums = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        sums = _mix(sums + words[k:len(words) - n + 1 + k] + _GOLDEN)
    return np.unique(sums, return_counts=True)


def prob_minhash(docs: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_docs: int) -> np.ndarray:
    """ProbMinHash signatures, one row of element hashes for each of ``n_docs`` documents.

    Each element sends arrivals of a Poisson process whose rate is its weight; an arrival goes to
    a random register, which keeps its earliest element. All elements take
    their first arrival, then those that are still earlier than their document's latest
    register go on, round by round, until none is. Two documents agree in a
    register with the probability Jaccard similarity of their weights.
    """
    first = np.full((n_docs, REGISTERS), np.inf)
    kept = np.zeros((n_docs, REGISTERS), np.uint64)
    at, state, when = docs, elements, np.zeros(len(docs))
    while len(at):
        # When few elements are left, several arrivals of each are taken at once; later ones do no harm.
        k = max(1, min(256, 8192 // len(at)))
        states = state[:, None] + _GOLDEN * np.arange(1, k + 1, dtype=np.uint64)
        random = _mix(states)
        gaps = -np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / weights[:, None]
        gaps[:, 0] += when
        times = np.cumsum(gaps, axis=1)
        register = (_mix(random) % np.uint64(REGISTERS)).astype(np.int64)
        doc = np.broadcast_to(at[:, None], register.shape)
        np.minimum.at(first, (doc, register), times)
        row, column = np.nonzero(times == first[doc, register])
        kept[at[row], register[row, column]] = elements[row]
        state, when = states[:, -1], times[:, -1]
        on = when < first.max(axis=1)[at]
        at, elements, weights, state, when = at[on], elements[on], weights[on], state[on], when[on]
    return kept


def _packed(signature: np.ndarray) -> np.ndarray:
    """Two bits of each register: 32 registers in a bigint."""
    bits = np.stack([signature & np.uint64(1), (signature >> np.uint64(1)) & np.uint64(1)], axis=2).astype(np.uint8)
    return np.packbits(bits.reshape(len(signature), 2 * REGISTERS), axis=1).view(np.int64)


def _word_hashes(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Runs of rows (start, stop) of about ``BATCH_WORDS`` words with the word hashes of each row."""
    words = batch.column("words")
    ends = words.offsets.to_numpy()
    flat = words.values.to_numpy(zero_copy_only=False).view(np.uint64)
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + BATCH_WORDS, "right")) - 1)
        stop = min(stop, batch.num_rows)
        yield start, stop, [flat[ends[i]:ends[i + 1]] for i in range(start, stop)]
        start = stop


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*values, np.empty(0, np.int64)]).view(np.int64), kind))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row number, size, sketch and bands in place of word hashes.

    Rows with the words of an earlier row of the task, and rows without a doc_id, get no sketch and no bands.
    """
    row, seen = TaskContext.get().partitionId() << 33, set()
    for batch in batches:
        keys = list(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist()))
        named = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        for start, stop, words in _word_hashes(batch):
            fresh = []
            for i in range(start, stop):
                if named[i] and len(words[i - start]) and keys[i] not in seen:
                    fresh.append(i - start)
                    if len(seen) < SEEN:
                        seen.add(keys[i])
            sets = [shingles(words[i]) for i in fresh]
            sizes = np.array([len(e) for e, _ in sets], np.int64)
            all_ = lambda k: np.concatenate([s[k] for s in sets]) if sets else np.empty(0, np.uint64)
            signature = prob_minhash(np.repeat(np.arange(len(sets)), sizes), all_(0), all_(1).astype(np.float64), len(sets))
            bands = np.zeros((len(sets), BANDS), np.uint64)
            for r in range(ROWS):
                bands = _mix(bands + signature.reshape(-1, BANDS, ROWS)[:, :, r] + np.arange(BANDS, dtype=np.uint64) * _GOLDEN + _GOLDEN)
            sketch, none = _packed(signature), np.empty(0, np.int64)
            of = {i: k for k, i in enumerate(fresh)}
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row + start, row + stop)), *[batch.column(c).slice(start, stop - start) for c in ("doc_id", "k1", "k2")],
                pa.array([len(w) for w in words], pa.int32()),
                _lists([sketch[of[i]] if i in of else none for i in range(stop - start)], pa.int64()),
                _lists([bands[of[i]].view(np.int64) if i in of else none for i in range(stop - start)], pa.int64()),
            ], names=["rid", "doc_id", "k1", "k2", "n", "sketch", "bands"])
        row += batch.num_rows


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")


def _hashed(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, k1, k2 (128 bits of the words) and words (hashes)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.coalesce(F.col(text), F.lit(""))).alias("w")).select(
        "doc_id", F.xxhash64(F.lit(1), "w").alias("k1"), F.xxhash64(F.lit(2), "w").alias("k2"), F.transform("w", lambda x: F.xxhash64(x)).alias("words"))


def signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """rid (row number), doc_id, k1, k2, n (words), sketch and bands of every row. Row numbers hold only once written."""
    return _hashed(docs, text).mapInArrow(_sign, "rid long, doc_id long, k1 long, k2 long, n int, sketch array<bigint>, bands array<bigint>")


def components(links: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = written) -> DataFrame:
    """(node, comp): the smallest node that each node of ``links`` (a, b) is connected with.

    Large-star and small-star steps in turn until nothing changes. Minima
    are combined on the map side, so a node with very many links costs one row for each task.
    """
    with Scratch(links.sparkSession) as scratch:
        edges = scratch.written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
        before = None
        while True:
            both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            # Large star: every larger neighbour of u goes to the smallest that u knows.
            large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
            # Small star: u and its smaller neighbours go to the smallest of them.
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).distinct()
            old, edges = edges, scratch.written(small, "edges")
            scratch.drop(old)
            now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if now == before:
                break
            before = now
        found = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        return keep(found.unionAll(found.select(F.col("comp").alias("node"), "comp")).distinct(), "components")


def _picked(nodes: DataFrame) -> DataFrame:
    return F.broadcast(nodes) if nodes.count() <= BROADCAST_IDS else nodes


def most_differing(threshold: float) -> int:
    """Registers whose two bits may differ in the sketches of a pair of similarity ``threshold``.

    Registers of similar texts agree with the probability s, their two bits with s + (1 - s) / 4;
    at the threshold itself three pairs in a million fall short of 4.5 standard deviations.
    """
    p = (1 - threshold) * 3 / 4
    return round(REGISTERS * p + 4.5 * (REGISTERS * p * (1 - p)) ** 0.5)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers in which sketches differ."""
    x = (a ^ b).view(np.uint64)
    return np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=-1, dtype=np.int32)


def prob_jaccard(e: np.ndarray, x: np.ndarray, f: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard similarity of weights ``x`` of elements ``e`` and ``y`` of ``f`` (both ascending)."""
    _, i, j = np.intersect1d(e, f, assume_unique=True, return_indices=True)
    x, y = x.astype(np.float64), y.astype(np.float64)
    order = np.argsort(y[j] / x[i], kind="stable")
    cx, cy = x[i][order], y[j][order]
    # For element i of ratio r = y_i / x_i, the larger of x_j and y_j / r is x_j if j has no larger ratio.
    below = x.sum() - cx.sum() + np.cumsum(cx)
    above = y.sum() - np.cumsum(cy)
    return float((cx / (below + above * cx / cy)).sum())


def connected(near: np.ndarray, test: Callable[[int, np.ndarray], np.ndarray] | None = None) -> list[tuple[list[int], list[int]]]:
    """Rows and columns that entries of ``near`` connect with each other, each row and column entered once.

    ``test`` looks closer at some columns of a row when they are about to be entered.
    """
    turned, found = np.ascontiguousarray(near.T), []
    rows, columns = np.ones(near.shape[0], bool), np.ones(near.shape[1], bool)
    for first in np.flatnonzero(near.any(axis=1)):
        if not rows[first]:
            continue
        rows[first], todo, group = False, [(0, int(first))], ([int(first)], [])
        while todo:
            side, k = todo.pop()
            new = np.flatnonzero(near[k] & columns if side == 0 else turned[k] & rows)
            if test is not None and len(new):
                new = new[test(k, new) if side == 0 else np.array([test(int(r), np.array([k]))[0] for r in new])]
            (columns if side == 0 else rows)[new] = False
            group[1 - side].extend(new.tolist())
            todo += [(1 - side, int(c)) for c in new]
        if group[1]:
            found.append(group)
    return found


def stars(groups: list[tuple[list[int], list[int]]], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs of the smallest node of each group and its others; groups of different buckets then often share pairs."""
    found = [np.empty((0, 2), np.int64)]
    for rows, columns in groups:
        nodes = np.unique(np.concatenate([left[rows], right[columns]]))
        found.append(np.stack([np.full(len(nodes) - 1, nodes[0]), nodes[1:]], axis=1))
    return np.concatenate(found)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups (g, i, j) from sorted rows, with the first row of each group and the number of rows."""
    held = None
    for batch in chain(batches, [None]):
        if batch is not None:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        if held is None or not held.num_rows:
            continue
        ids = np.stack([held.column(c).to_numpy() for c in ("g", "i", "j")])
        starts = np.concatenate([[0], 1 + np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0))])
        if batch is None:
            yield held, np.append(starts, held.num_rows)
        elif len(starts) > 1:
            yield held.slice(0, int(starts[-1])), starts
            held = held.slice(int(starts[-1]))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, width)


def _sides(table: pa.Table, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a group to compare: those of side 0 or 2 with those of side 1 or 2."""
    side = table.column("side").to_numpy()[start:stop]
    return start + np.flatnonzero(side != 1), start + np.flatnonzero(side != 0)


def _near_sketches(most: int) -> Callable:
    """Pairs that connect as much as all pairs do whose sketches differ in at most ``most`` registers."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _runs(batches):
            node, comp = table.column("node").to_numpy(), table.column("comp").to_numpy()
            sketch, pairs = _matrix(table.column("sketch"), REGISTERS // 32), []
            sizes = np.diff(starts)
            # Small groups at once: each row with the k-th after it.
            small = (sizes <= 4) & (table.column("side").to_numpy()[starts[:-1]] == 2)
            group = np.repeat(np.where(small, np.arange(len(sizes)), -1), sizes)
            for k in range(1, 4):
                a = np.flatnonzero((group[:-k] == group[k:]) & (group[k:] >= 0)) if len(group) > k else np.empty(0, int)
                a = a[comp[a] != comp[a + k]]
                a = a[differing(sketch[a], sketch[a + k]) <= most]
                pairs.append(np.stack([node[a], node[a + k]], axis=1))
            for g in np.flatnonzero(~small):
                left, right = _sides(table, starts[g], starts[g + 1])
                near = np.concatenate([np.zeros((0, len(right)), bool), *[
                    differing(sketch[left[k:k + 64], None, :], sketch[None, right, :]) <= most for k in range(0, len(left), 64)]])
                near &= comp[left][:, None] != comp[right][None, :]
                pairs.append(stars(connected(near), node[left], node[right]))
            pairs = np.concatenate(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return compare


def _near_texts(threshold: float) -> Callable:
    """Pairs that connect as much as all pairs of similarity ``threshold`` or more do, exactly."""

    def linked(sets: list, left: np.ndarray, right: np.ndarray, differ: np.ndarray) -> list[tuple[list[int], list[int]]]:
        """Of weights in shared shingles u and v, 1 / (1/u + 1/v - 1) bounds the similarity from above, and is exact if counts are in one ratio."""
        which = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
        elements, weights = np.concatenate([e for e, _ in sets]), np.concatenate([w for _, w in sets])
        order = np.argsort(elements, kind="stable")
        new = np.concatenate([[True], elements[order][1:] != elements[order][:-1]])
        shared = ~(new & np.concatenate([new[1:], [True]]))
        column, rows, weights = np.cumsum(new & shared)[shared] - 1, which[order][shared], weights[order][shared]
        ones = np.array([w.max() == 1 for _, w in sets])
        u, v = np.zeros((len(left), len(right)), np.float32), np.zeros((len(left), len(right)), np.float32)
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            at = slice(*np.searchsorted(column, [first, first + COLUMNS]))
            block = np.zeros((len(sets), int(column[at][-1]) + 1 - first), np.float32)
            block[rows[at], column[at] - first] = weights[at]
            u += block[left] @ (block[right] > 0).astype(np.float32).T
            v += (block[left] > 0).astype(np.float32) @ block[right].T
        total = np.array([w.sum() for _, w in sets], np.float64)
        u, v = u.astype(np.float64), v.astype(np.float64)
        near = differ & (u > 0) & (u * v >= (threshold - 1e-9) * (total[left][:, None] * v + total[right][None, :] * u - u * v))

        def test(r: int, c: np.ndarray) -> np.ndarray:
            return np.array([
                (ones[left[r]] and ones[right[k]]) or prob_jaccard(*sets[left[r]], *sets[right[k]]) >= threshold - 1e-12 for k in c], bool)

        return connected(near, None if ones.all() else test)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _runs(batches):
            node, comp, pairs = table.column("node").to_numpy(), table.column("comp").to_numpy(), [np.empty((0, 2), np.int64)]
            lists = table.column("elements").combine_chunks()
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            e, n = lists.flatten().to_numpy().view(np.uint64), table.column("counts").combine_chunks().flatten().to_numpy()
            for g in range(len(starts) - 1):
                left, right = _sides(table, starts[g], starts[g + 1])
                sets = [(e[at[k]:at[k + 1]], n[at[k]:at[k + 1]]) for k in range(starts[g], starts[g + 1])]
                differ = comp[left][:, None] != comp[right][None, :]
                pairs.append(stars(linked(sets, left - starts[g], right - starts[g], differ), node[left], node[right]))
            pairs = np.concatenate(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return compare


def _compared(rows: DataFrame, compare: Callable) -> DataFrame:
    """(a, b): what ``compare`` finds in each group (g, i, j) of ``rows``."""
    return rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j").mapInArrow(compare, "a long, b long").distinct()


def group_links(rows: DataFrame, compare: Callable, payload: list[str], scratch: Scratch, narrow: Callable | None = None) -> DataFrame:
    """(a, b): links between rows of a group, so many that all others of the group follow from them.

    ``rows`` has g (group), node, blocks (the number of blocks that its group is cut into) and ``payload``.
    The first block of a group is compared with every block. That settles
    groups of one block. In larger ones, what is not connected with most of the group by
    then is cut into blocks again and compared with every block. So a group
    of near copies costs work in proportion to its size, no task gets more than two blocks, and no pair
    of a group that could connect it further stays untested. ``narrow`` may settle groups in another way: it gives further
    links, and pairs of row sets that are left to be compared in blocks.
    """
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    at = rows.withColumn("block", block).withColumn("comp", F.col("node"))
    leads = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).otherwise(F.array("block"))
    first = at.withColumn("j", F.explode(leads)).select(
        "g", F.lit(0).alias("i"), "j", F.when(F.col("j") == 0, 2).when(F.col("block") == 0, 0).otherwise(1).alias("side"), "node", "comp", *payload)
    links = scratch.written(_compared(first, compare), "links")
    large = at.filter("blocks > 1")
    if large.isEmpty():
        return links
    comp = components(links, scratch.written)
    labelled = large.drop("comp").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    main = labelled.groupBy("g", "comp").agg(F.count("*").alias("c")).groupBy("g").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("all"))
    labelled = labelled.join(main, "g").withColumn("outside", F.col("comp") != F.col("main")).drop("main")
    if narrow is not None:
        labelled = scratch.written(labelled, "labelled")
        more, crossings = narrow(labelled, scratch)
        links = scratch.written(links.unionAll(more), "links")
    else:
        crossings = [(labelled.filter("outside"), labelled)]
    names = ["g", "i", "j", "side", "node", "comp", *payload]
    for k, (left, right) in enumerate(crossings):
        # Blocks of about the same size as before.
        parts = left.groupBy("g").agg(F.ceil(F.count("*") * F.first("blocks") / F.first("all")).cast("int").alias("parts"))
        sent = left.join(parts, "g").withColumn("i", F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int") + 1).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
        met = right.join(parts, "g").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("parts")))).withColumn("j", F.col("block"))
        second = sent.withColumn("side", F.lit(0)).select(names).unionAll(met.withColumn("side", F.lit(1)).select(names))
        links = scratch.written(links.unionAll(_compared(second, compare)), "links")
    return links


def _narrowed(threshold: float) -> Callable:
    """For families: pairs with a member outside the main part are found by what they do not share with most of their family.

    Let the core be the shingles of more than half of a family, and D(x) what x has beside the core or lacks of it. Sets x and y
    differ in |D(x)| + |D(y)| - 2 |D(x) and D(y)| shingles, and are similar if that is at most (1 - t) / (1 + t) (|x| + |y|). With s(x) = |D(x)| -
    (1 - t) / (1 + t) |x| this is 2 |D(x) and D(y)| >= s(x) + s(y). So a similar pair either has s(x) + s(y) <= 0, and then both are similar to the
    member of the smallest s as well; or it shares a part of D, and meets in a group under that shingle. Groups of the same members are one. In a loose
    family, whose members differ in shingles of their own, no two meet, and rows grow with the family, not with its square.

    Texts that repeat shingles are not told by sets; they, and families whose groups would send more rows than blocks do, are left to the blocks. That
    choice changes which rows are sent, never which pairs are tested.
    """
    ratio = (1 - threshold) / (1 + threshold)

    def narrow(labelled: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
        plain = F.array_max("counts") == 1
        sets = labelled.filter(plain).select("g", "node", "comp", "outside", "elements")
        size = sets.groupBy("g").agg(F.count("*").alias("c"))
        core = sets.select("g", F.explode("elements").alias("e")).groupBy("g", "e").agg(F.count("*").alias("n")).join(size, "g").filter("2 * n > c")
        core = scratch.written(core.groupBy("g").agg(F.collect_list("e").alias("core")), "core")
        # Flags tell shingles that a text has from those it lacks.
        differs = F.concat(F.array_except("elements", "core"), F.transform(F.array_except("core", "elements"), lambda e: F.xxhash64(e)))
        own = sets.join(core, "g", "left").withColumn("core", F.coalesce("core", F.slice("elements", 1, 0)))
        own = scratch.written(own.select("g", "node", "comp", "outside", differs.alias("d"), F.size("elements").alias("size")).withColumn("s", F.size("d") - F.lit(ratio) * F.col("size")).drop("size"), "differences")
        least = own.groupBy("g").agg(F.min_by(F.struct("node", "s"), F.struct("s", "node")).alias("m"))
        star = own.join(least, "g").filter((F.col("s") + F.col("m.s") <= 1e-9) & (F.col("node") != F.col("m.node"))).select(F.least("node", "m.node").alias("a"), F.greatest("node", "m.node").alias("b"))
        star = scratch.written(star, "links")
        shared = own.select("g", "node", "comp", "outside", F.explode("d").alias("e"))
        keys = shared.groupBy("g", "e").agg(
            F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h"),
            F.max("outside").alias("o"), (F.min("comp") < F.max("comp")).alias("apart")).filter("n > 1 and o and apart")
        keys = scratch.written(keys.groupBy("g", "n", "low", "high", "h").agg(F.min("e").alias("e")).select("g", "e", "n"), "keys")
        rows = labelled.groupBy("g").agg((F.count_if("outside") * F.first("blocks") + F.count("*") * F.ceil(F.count_if("outside") * F.first("blocks") / F.first("all"))).alias("rows"))
        few = scratch.written(keys.groupBy("g").agg(F.sum("n").alias("sent")).join(rows, "g", "right").filter(F.coalesce("sent", F.lit(0)) <= F.col("rows")).select("g"), "narrowed")
        groups = shared.join(_picked_keys(keys.join(few, "g").drop("n")), ["g", "e"]).select(F.xxhash64("g", "e").alias("key"), "node")
        met = groups.join(labelled.select("node", "elements", "counts"), "node").withColumnRenamed("key", "g")
        met = scratch.written(met, "met")
        blocks = met.groupBy("g").agg(F.ceil(F.greatest(F.count("*") / FAMILY_ROWS, F.sum(F.size("elements")) / FAMILY_SHINGLES)).cast("int").alias("blocks"))
        found = group_links(met.join(blocks, "g"), _near_texts(threshold), ["elements", "counts"], scratch)
        # Left to the blocks: families that are not narrowed, and in others the texts with repeats: outside ones against all, all of them against outside ones without.
        told = labelled.join(_picked(few), "g", "left_semi")
        rest = labelled.join(_picked(few), "g", "left_anti")
        return star.unionAll(found), [(rest.filter("outside"), rest), (told.filter(F.col("outside") & ~plain), told), (told.filter(~plain), told.filter(F.col("outside") & plain))]

    return narrow


def _picked_keys(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles and their counts in place of word hashes."""
    for batch in batches:
        for start, stop, words in _word_hashes(batch):
            sets = [shingles(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).slice(start, stop - start) for c in ("doc_id", "k1", "k2")], _lists([e for e, _ in sets], pa.int64()), _lists([c for _, c in sets], pa.int64())],
                names=["doc_id", "k1", "k2", "elements", "counts"])


def near_duplicates(docs: DataFrame, text: str = "text", threshold: float = 0.8) -> DataFrame:
    """doc_id and class_id, one row for each row of ``docs``.

    Rows with equal words are one node, its first row. Nodes that agree in a band meet in a bucket;
    sketches tell which of them can be similar, and what these connect are
    families. The shingles of a family are compared exactly, in blocks (``group_links``), so
    no pair that bands and sketches propose stays untested unless its nodes are connected already, and a
    group of copies makes links in proportion to its size. A
    class is a connected component of links; class_id is its smallest doc_id. Texts without words (null, empty)
    are equal to nothing: each doc_id is its own class. Rows with words that share a doc_id share a class; rows
    without a doc_id take no part and have no class.
    """
    with Scratch(docs.sparkSession) as scratch:
        every = scratch.written(signatures(docs, text), "signatures")
        worded = every.filter("n > 0 and doc_id is not null")
        again = scratch.written(worded.groupBy("k1", "k2").agg(F.min("rid").alias("node"), F.count("*").alias("c")).filter("c > 1").drop("c"), "copies")
        copies = scratch.written(worded.select("rid", "k1", "k2").join(_picked(again), ["k1", "k2"]).select("rid", "node"), "copies")
        families = _families(every, copies, threshold, scratch)
        members = every.select("rid", "doc_id", "k1", "k2").join(_picked(families), F.col("rid") == F.col("node")).drop("rid")
        members = scratch.written(members, "members")
        wanted = _picked(members.select("doc_id").distinct())
        # Rows that share a doc_id: the one that was signed.
        sets = _hashed(docs, text).join(wanted, "doc_id", "left_semi").select("doc_id", "k1", "k2", "words").mapInArrow(
            _counted, "doc_id long, k1 long, k2 long, elements array<bigint>, counts array<bigint>")
        sets = scratch.written(sets.join(_picked(members), ["doc_id", "k1", "k2"]).dropDuplicates(["node"]).select("g", "node", "elements", "counts"), "shingles")
        blocks = sets.groupBy("g").agg(F.ceil(F.greatest(F.count("*") / FAMILY_ROWS, F.sum(F.size("elements")) / FAMILY_SHINGLES)).cast("int").alias("blocks"))
        links = group_links(sets.join(blocks, "g"), _near_texts(threshold), ["elements", "counts"], scratch, _narrowed(threshold))
        # Rows that share a doc_id but not their words link their nodes.
        named = scratch.written(every.select("rid", "doc_id", "n").join(copies, "rid", "left").select("doc_id", "n", F.coalesce("node", "rid").alias("node")), "named")
        twice = named.filter("n > 0").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").drop("b")
        own = named.filter("n > 0").join(twice, "doc_id").select("a", F.col("node").alias("b"))
        comp = components(links.unionAll(own), scratch.written)
        named = named.join(comp, "node", "left").select("doc_id", "node", F.coalesce("comp", "node").alias("comp"))
        least = named.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("c")).filter("c > 1").drop("c")
        return written(named.join(least, "comp", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")), "classes")


def _families(every: DataFrame, copies: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """(node, g): nodes that have a similar sketch in a bucket, by what such pairs connect."""
    order = Window.partitionBy("key").orderBy("rid")
    entries = every.select("rid", F.explode("bands").alias("key"))
    entries = entries.select("key", "rid", F.lag("rid").over(order).alias("p"), F.lead("rid").over(order).alias("q")).filter("p is not null or q is not null")
    entries = scratch.written(entries.select("key", "rid"), "buckets")
    named = entries.join(copies, "rid", "left").select("key", F.coalesce("node", "rid").alias("node")).distinct()
    sizes = named.groupBy("key").agg(F.ceil(F.count("*") / BUCKET_ROWS).cast("int").alias("blocks"), F.count("*").alias("c")).filter("c > 1").drop("c")
    buckets = scratch.written(named.join(sizes, "key").withColumnRenamed("key", "g"), "buckets")
    nodes = scratch.written(buckets.select("node").distinct(), "nodes")
    sketches = every.select(F.col("rid").alias("node"), "sketch").join(_picked(nodes), "node", "left_semi")
    near = group_links(buckets.join(sketches, "node"), _near_sketches(most_differing(threshold)), ["sketch"], scratch)
    return components(near, scratch.written).withColumnRenamed("comp", "g")


def keep_one(docs: DataFrame, text: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class: the smallest doc_id, of its rows any one. Rows without a doc_id stay."""
    classed = near_duplicates(docs, text, threshold)
    gone = written(classed.filter("doc_id <> class_id").select("doc_id").distinct(), "gone")
    kept = docs.join(_picked(gone), "doc_id", "left_anti").select(docs.columns)
    repeated = classed.filter("doc_id = class_id").groupBy("doc_id").count().filter("count > 1")
    return kept if repeated.isEmpty() else _one_each(kept, written(repeated.select("doc_id"), "repeated"))


def _one_each(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` with one row for each doc_id of ``repeated``; the others' texts are not shuffled."""
    twice = docs.join(_picked(repeated), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return docs.join(_picked(repeated), "doc_id", "left_anti").select(docs.columns).unionAll(twice.select(docs.columns))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
