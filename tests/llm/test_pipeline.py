"""The pipeline, stage by stage, and null ids everywhere."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import minhash, mixing, packing, pii, quality, simhash, token_counts, token_files
from tidemark.llm.bpe import tokenizer_path
from tidemark.llm.common import new_folder, written


def test_stages_follow_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, outs = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        outs.append(written(stage(spark, outs[-1], sf_dir), "test"))
    for df in outs[1:-1]:
        assert df.columns == columns
    ids = [Counter(r.doc_id for r in df.select("doc_id").collect()) for df in outs]
    rejected = {r.doc_id for r in quality.quality_rules(docs).filter("not kept").collect()}
    assert set(ids[1]) == set(ids[0]) - rejected and rejected
    classes = {r.class_id for r in minhash.near_duplicates(outs[1]).collect()}
    assert set(ids[2]) == classes and max(ids[2].values()) == 1
    assert ids[3] == ids[2]
    assert outs[3].filter("text like '%@mail%'").count() == 0 and outs[3].filter("text like '%[EMAIL]%'").count() > 0
    assert set(ids[4]) == set(ids[3]) and max(ids[4].values()) <= 2
    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    rows = outs[5].collect()
    texts = {r.doc_id: r.text for r in outs[4].collect()}
    pieces, windows = Counter(), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        windows[r.sequence_id].append((r.offset, r.length))
    want = Counter()
    for d, copies in ids[4].items():
        tokens = np.array([*lib.encode(texts[d], add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(tokens), 2048):
            part = tokens[at:at + 2048]
            want[d, at, len(part), zlib.crc32(part.tobytes()), len(tokens)] += copies
    assert pieces == want
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_quality_stage_removes_frequent_lines(spark, tmp_path):
    name = lambda i: "abc"[i // 10] + "klmnopqrst"[i % 10]
    body = lambda i: " ".join(f"{name(i)}{name(k)}" for k in range(20))
    texts = {i: (f"Home  news {i % 10}\n{body(i)}\n\n  All rights reserved. ", f"{body(i)}\n") for i in range(30)}
    rows = [(i, t if i else f"{t}\n{t}", "en", "h", 1) for i, (t, _) in texts.items()] + [(100, texts[1][0], "en", "other", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()}
    assert {i: got[i] for i in range(1, 30)} == {i: want for i, (_, want) in texts.items() if i} and got[100] == texts[1][0]
    clean = {r.doc_id: r.clean_text for r in quality.quality_rules(docs).collect()}
    assert clean[0] == f"{body(0)}\n\n{body(0)}\n" and clean[100] == texts[1][0]


def test_stages_leave_other_columns_alone(spark, tmp_path):
    """Columns named like those that operators add or use inside pass every stage unchanged."""
    names = ["n_words", "kept", "clean_text", "row", "host", "node", "class_id", "base", "spans", "scores", "_text", "epoch", "mix_block", "key", "src", "_rest", "-"]
    body = lambda i: " ".join("".join("klmnopqrst"[int(c)] for c in f"{i}{k}") for k in range(40))
    rows = [(i, body(i), "en", "s" if i % 2 else None, i, *[f"{n} {i}" for n in names]) for i in range(20)]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long", *[f"`{n}` string" for n in names]]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert {tuple(r) for r in out.collect()} == set(rows), name


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 500


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None, None, None, None, None), (None, "a b c", "en", "s", 5), (2**60 + 1, "x y z " * 30, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_null_ids(spark, odd, tmp_path):
    n = odd.count()
    want = Counter(r.doc_id for r in odd.collect())
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    assert ids(quality.quality_rules(odd)) == want and ids(pii.personal_data(odd)) == want and ids(token_counts.token_counts(odd)) == want
    assert ids(packing.pack(odd)) == want and ids(minhash.near_duplicates(odd)) == want
    assert ids(token_files.read_token_files(token_files.write_token_files(odd, new_folder(spark, "t")))) == want
    assert ids(simhash.op4_simhash(spark, str(tmp_path))) == want
    assert set(ids(mixing.mix_sources(odd))) == set(want) and mixing.mix_sources(odd).count() >= n
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd.limit(0), str(tmp_path)).columns == odd.columns
