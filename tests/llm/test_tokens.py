"""Encoding by parts, token counts and packing against the library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, token_counts
from tidemark.llm.bpe import Encoder, tokenizer_path

EDGE = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\n b", "\n", "x\n y", "It's  we'll I'D don't 'sabc", "<|endoftext|> a <|startoftext|>", "<|ENDOFTEXT|>",
    "É café ΟΔΟΣ İstanbul ß", "tab\tq \t z\r\n w", "12345 1,000.50 $%^&*() ——…“q”", "日本語 テスト 🙂🙂", " x y", "x" * 3000, "a\x1cb", "word,word.word!word?", "a " * 500,
]


@pytest.fixture(scope="module", params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def pair(request):
    return Encoder(request.param), Tokenizer.from_file(tokenizer_path(request.param))


def test_ids_and_counts_equal_the_library(pair):
    """Edge texts, random joins of odd parts, and every character of the basic plane beside its neighbours."""
    ours, lib = pair
    rnd = random.Random(1)
    parts = ["the", "Über", "don't", "x1", "...", "\n", " ", "  ", "\t", "!", "'s", "É", "it'S", "«", "-", "\n\n", "é", "42", "ΟΔΟΣ", "Σ", "İ", "\xa0", "\u2003", "\x1c", "\x85", "\u0301",
             "<|endoftext|>", "<|", "🙂", "\x00", "ß", "ǅ", "\u200d", "١٢", "𝒳", "\r\n", "\u3000", "\ufeff", "Привет", "नमस्ते", "กขค", "日本語", "'", "’t"]
    texts = EDGE + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) for _ in range(10_000)]
    texts += ["".join(map(chr, range(k, k + 97))) for k in range(0, 0xD700, 97)]
    for text in texts:
        want = lib.encode(text, add_special_tokens=False).ids
        assert ours.ids(text).tolist() == want and ours.count(text) == len(want), repr(text)


def test_all_documents_of_the_largest_table_equal_the_library(spark):
    """Ids of every text at scale factor 0.1 by both vocabularies, compared in tasks."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").repartition(16)

    def wrong(frames):
        pairs = [(Encoder(n), Tokenizer.from_file(tokenizer_path(n))) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")]
        for frame in frames:
            texts = frame["text"].tolist()
            bad = sum(ours.ids(t).tolist() != e.ids for ours, lib in pairs for t, e in zip(texts, lib.encode_batch_fast(texts, add_special_tokens=False)))
            yield pd.DataFrame({"bad": [bad], "n": [len(texts)]})

    assert tuple(docs.mapInPandas(wrong, "bad long, n long").selectExpr("sum(bad)", "sum(n)").first()) == (0, 10_000)


def test_token_counts(spark, sf_dir):
    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = token_counts.op2_token_counts(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        n = len(lib.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 2048)


def test_token_counts_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (2, "a b", None)], "doc_id long, text string, n_tokens string")
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs).collect()) == [(1, 0, 0), (1, 0, 0), (2, 3, 2)]
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def check_pieces(rows, texts, lib, size=2048):
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, pieces in by_doc.items():
        ids = np.array([*lib.encode(texts[d] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_window.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    return sum(r.length for r in rows), len(by_window)


def test_items_go_where_they_fit_best():
    """Windows closed by the bounded-space packer against a scan of all open windows for each item."""
    rnd = random.Random(4)
    for n_open in (1, 2, 5, 64):
        ours, plain, made = packing.OpenWindows(100, n_open), [], 0
        for k in range(3000):
            n, closed = rnd.randrange(1, 101), []
            fits = [w for w in plain if w[0] >= n]
            if fits:
                best = min(fits, key=lambda w: (w[0], w[1]))
            else:
                if len(plain) >= n_open:
                    fullest = min(plain, key=lambda w: (w[0], w[1]))
                    plain.remove(fullest)
                    closed.append(fullest[2])
                made += 1
                best = [100, made, []]
                plain.append(best)
            best[0] -= n
            best[2].append([n, k])
            if best[0] == 0:
                plain.remove(best)
                closed.append(best[2])
            assert ours.add([n, k]) == closed
        assert sorted(ours.rest()) == sorted(w[2] for w in plain)


def test_packing(spark, sf_dir):
    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    tokens, windows = check_pieces(packing.op5_packing(spark, sf_dir).collect(), docs, lib)
    assert tokens > 0.95 * 2048 * (windows - 1)


def test_packing_many_partitions_merges_leftovers(spark):
    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    texts = {i: None if i == 7 else "" if i == 8 else "word " * (i * 37 % 1500) for i in range(120)}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, ids string").repartition(20)
    rows = packing.pack(docs, n_open=2, fan_in=4, keep_ids=True).collect()
    tokens, windows = check_pieces(rows, texts, lib)
    assert windows <= 1.2 * tokens / 2048 + 1
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack(docs.limit(0)).count() == 0
