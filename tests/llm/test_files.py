"""Token files and sharding: exact round trips."""

import random
import zlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from tidemark.llm import sharding, token_files
from tidemark.llm.bpe import tokenizer_path
from tidemark.llm.common import new_folder


def expected(texts, order=lambda t: len(t)):
    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    out, at = [], 0
    for d, t in sorted(texts, key=lambda x: (x[0], order(x[1] or ""))):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_whole_table(spark, sf_dir):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, token_files.op3_token_files(spark, sf_dir).collect())) == expected(texts)


def test_odd_tables_and_random_access(spark):
    texts = [(5, None, "x"), (5, "", "x"), (7, "one two", "x"), (-3, "word " * 3000, "x"), (9, "z", None), (9, "z", None), *[(100 + i, f"text number {i}", "y") for i in range(300)]]
    docs = spark.createDataFrame(texts, "doc_id long, text string, start string")
    manifest = token_files.write_token_files(docs, new_folder(spark, "t"), frame_ids=500).cache()
    assert sorted(map(tuple, token_files.read_token_files(manifest).collect())) == expected([t[:2] for t in texts])
    seen = []
    for row in manifest.collect():
        with token_files.open_file(row.path) as f:
            reader = token_files.Reader(f)
            calls = []
            frame, reader.frame = reader.frame, lambda k: calls.append(k) or frame(k)
            seen += [(d.doc_id, len(d.ids)) for d in reader.documents({5, 9, 250})]
            assert len(calls) < max(3, len(reader.index))
    assert sorted(x[0] for x in seen) == [5, 5, 9, 9, 250]
    assert token_files.read_token_files(token_files.write_token_files(docs.limit(0), new_folder(spark, "t"))).count() == 0


def test_frames_stand_alone_and_damage_is_found(tmp_path):
    path = tmp_path / "a.zst"
    with open(path, "wb") as out:
        writer = token_files.Writer(out, frame_ids=10)
        for i in range(20):
            writer.add(i, np.arange(i, dtype="<u4"))
        writer.close()
    with token_files.open_file(f"file://{path}") as f:
        reader = token_files.Reader(f)
        assert [(d.doc_id, d.ids.tolist()) for d in reader.all()] == [(i, list(range(i))) for i in range(20)]
        raw = path.read_bytes()
        at = int(reader.at[2])
        assert zstandard.ZstdDecompressor().decompress(raw[at:at + int(reader.table["packed"][2])], max_output_size=1 << 20)
    damaged = bytearray(raw)
    damaged[at + 12] ^= 1
    path.write_bytes(damaged)
    with token_files.open_file(f"file://{path}") as f, pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.Reader(f).all())


def rows_of(df):
    return sorted((r.doc_id, r.text or "", r.extra or "") for r in df.collect())


def test_arrivals_are_merged_by_tier(spark):
    store = sharding.ShardStore(spark, new_folder(spark, "s"), target_bytes=60_000, fan_in=3, smallest_bytes=2_000)
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 50 = 0, null, sha2(string(id), 256)) as text", "if(id % 7 = 0, null, 'e') as extra")
    for k in range(7):
        store.append(docs.filter(f"doc_id % 7 = {k}").repartition(2))
        store.compact()
    assert rows_of(store.read()) == rows_of(docs)
    last = store.manifest()
    assert not store.due(last["shards"]) and len(last["shards"]) < 10
    assert rows_of(store.read(1)) == rows_of(docs.filter("doc_id % 7 = 0")), "old versions stay readable"


def test_commits_conflict_instead_of_losing_shards(spark):
    store = sharding.ShardStore(spark, new_folder(spark, "s"))
    base = store.manifest()
    store.append(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    with pytest.raises(sharding.CommitConflict):
        store.commit(base, [])
    assert store.read().count() == 1


def test_a_compaction_keeps_what_arrives_meanwhile(spark, monkeypatch):
    """An arrival, with a new column, between a merge and its commit; then a second compaction of the same shards that comes too late."""
    store = sharding.ShardStore(spark, new_folder(spark, "s"), target_bytes=100_000, fan_in=3, smallest_bytes=10_000)
    for k in range(3):
        store.append(spark.createDataFrame([(k, "a")], "doc_id long, text string").coalesce(1))
    other = sharding.ShardStore(spark, store.root, store.target_bytes, store.fan_in, store.smallest_bytes)
    late, write, before = store.manifest(), store._write, store.manifest()

    def meanwhile(df, merged):
        made = write(df, merged)
        if merged and store.manifest() == before:
            other.append(spark.createDataFrame([(9, "b", "e")], "doc_id long, text string, extra string").coalesce(1))
        return made

    monkeypatch.setattr(store, "_write", meanwhile)
    last = store.compact()
    assert last["version"] == before["version"] + 2 and sorted(s["merged"] for s in last["shards"]) == [False, True]
    assert rows_of(store.read()) == [(0, "a", ""), (1, "a", ""), (2, "a", ""), (9, "b", "e")]
    monkeypatch.setattr(other, "manifest", lambda version=None, first=[late]: first.pop() if first else store.manifest(version))
    assert other.compact() == last, "its merge is left out, since its shards are merged already"
    assert rows_of(store.read()) == [(0, "a", ""), (1, "a", ""), (2, "a", ""), (9, "b", "e")]


def test_arrivals_and_compactions_at_once(spark):
    root = new_folder(spark, "s")
    stores = [sharding.ShardStore(spark, root, 100_000, 2, 10_000) for _ in range(4)]

    def work(k):
        for i in range(4):
            if k < 3:
                stores[k].append(spark.createDataFrame([(10 * k + i, "t")], "doc_id long, text string").coalesce(1))
            else:
                stores[k].compact()

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, range(4)))
    stores[0].compact()
    assert [r[0] for r in sorted(stores[0].read().select("doc_id").collect())] == [0, 1, 2, 3, 10, 11, 12, 13, 20, 21, 22, 23]
    assert not stores[0].due(stores[0].manifest()["shards"])


def test_sharding_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = sharding.op8_sharding(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.text_crc32) for r in got} == {d: (len(t.encode()), zlib.crc32(t.encode())) for d, t in docs.items()}
    assert len(got) == len(docs)


def test_columns_of_all_arrivals_survive_compaction(spark):
    """New, missing and retyped columns, one that is called like an inner name, nulls, repeats and an empty arrival."""
    store = sharding.ShardStore(spark, new_folder(spark, "s"), target_bytes=100_000, fan_in=2, smallest_bytes=2_000)
    long = "é" * 200_000
    store.append(spark.createDataFrame([(1, "a", "mine"), (1, "a", "mine"), (None, None, None)], "doc_id long, text string, _shard string").coalesce(1))
    store.append(spark.createDataFrame([(2, long, 0.5, [1])], "doc_id long, text string, extra double, merged array<int>").coalesce(1))
    store.append(spark.createDataFrame([], "doc_id long, late date"))
    for bad in ("doc_id string", "doc_id long, EXTRA double"):
        with pytest.raises(ValueError):
            store.append(spark.createDataFrame([], bad))

    def seen():
        return sorted(((r.doc_id or 0), r.text or "", r["_shard"], r.extra, r.merged, r.late) for r in store.read().collect())

    before = seen()
    assert before == [(0, "", None, None, None, None), (1, "a", "mine", None, None, None), (1, "a", "mine", None, None, None), (2, long, None, 0.5, [1], None)]
    store.compact()
    assert seen() == before and any(s["merged"] for s in store.manifest()["shards"])
    assert store.read().columns == ["doc_id", "text", "_shard", "extra", "merged", "late"]
    assert store.read(merged=True).count() + store.read(merged=False).count() == 4


def test_tiers_merge_runs_of_like_size_only(spark):
    """What is due follows from sizes alone: a plain model of tiers picks the same runs."""
    store = sharding.ShardStore(spark, "file:///tmp/none", target_bytes=64_000, fan_in=4, smallest_bytes=1_000)
    rnd = random.Random(1)
    for _ in range(200):
        shards = [{"path": str(k), "bytes": int(2 ** rnd.uniform(8, 17))} for k in range(rnd.randrange(0, 30))]
        tiers = {}
        for s in shards:
            if s["bytes"] < 32_000:
                k = 0
                while s["bytes"] >= 1_000 * 4 ** (k + 1):
                    k += 1
                tiers.setdefault(k, []).append(s)
        assert store.due(shards) == [t for _, t in sorted(tiers.items()) if len(t) >= 4]


def test_empty_arrival(spark):
    store = sharding.ShardStore(spark, new_folder(spark, "s"))
    store.append(spark.createDataFrame([], "doc_id long, text string"))
    assert store.compact()["version"] >= 1 and store.read().count() == 0
