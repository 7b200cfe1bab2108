"""Collocations against counting all phrases in Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import collocations as c

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, least=30, inside=80, top=2000):
    out, (f, n) = [], counted(rows)
    for lang, seen in f.items():
        found = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i:i + k]] = max(longer[p[i:i + k]], a)
        best = []
        for p, a in found.items():
            if p not in longer or 100 * longer[p] < inside * a:
                score, k = min((2000000 * a // (seen[p[:k]] + seen[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), seen[p[:k]], seen[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(best)[:top])]
    return sorted(out)


def rows():
    rnd = random.Random(11)
    words = ["alpha", "Beta", "gamma", "ÄPFEL", "äpfel", "δ", "x", "новый", " ", "it's", "a-b", "🙂"]
    texts = [(rnd.choice(["en", "de", None, "und", ""]), "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\r\n"]) for _ in range(rnd.randrange(60)))) for _ in range(300)]
    texts += [("en", None), ("en", ""), (None, None), ("fr", " \t.\n"), ("en", "no end no end " * 40), ("de", "only once here"), ("en", "one phrase here. " * 29 + "One Phrase HERE")]
    return texts * 2 + [("xx", "lonely words")]


def run(spark, table, **kw):
    docs = spark.createDataFrame([(a, b, "z", 1, "p") for a, b in table], "lang string, text string, phrase string, n int, w string").repartition(4)
    return sorted(tuple(r) for r in c.collocations(docs, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"least": 3}, {"least": 100, "inside": 50}, {"least": 5, "top": 4}])
def test_same_as_brute_force(spark, kw):
    got = run(spark, rows(), **kw)
    assert got == brute(rows(), **kw) and got


def test_border_failures_are_followed_up(spark):
    """A sample of almost nothing proposes nothing: every length takes a further pass, and the result is the same."""
    assert run(spark, rows(), share=0.0001) == run(spark, rows(), share=1.0) == brute(rows())


def test_small_filters_cost_time_only(spark):
    texts = spark.createDataFrame(rows(), "lang string, text string").selectExpr("coalesce(lang, 'und') as lang", "coalesce(text, '') as text")
    old = c.LEAST_BITS
    try:
        c.LEAST_BITS = 64
        got = {(r.lang, r.phrase): r.c for r in c.frequent_phrases(texts, 10, most_bits=64).collect() if r.n}
    finally:
        c.LEAST_BITS = old
    f, _ = counted(rows())
    assert got == {(lang, " ".join(p)): a for lang, seen in f.items() for p, a in seen.items() if a >= 10}


def test_no_words_and_empty_tables(spark):
    assert run(spark, [("en", None), (None, " ")]) == []
    assert c.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_chunks_cut_between_pieces_only(monkeypatch):
    """Long texts are cut, rows and words are the same for any size of chunk, and also if a piece is longer than one."""
    table = ["aa bb. cc dd, ee", "", "ff " * 50, "", "", "gg. hh", "ii\njj kk ll mm"] * 3
    for size in (1, 3, 7, 40, 10_000):
        monkeypatch.setattr(c, "CHUNK", size)
        for start in (0, 2):
            texts, seen = pa.array(["skip"] * start + table, pa.string()).slice(start), []
            for data, ends, first in c._chunks(texts):
                words, row, linked = c._words(data, ends)
                row = row + first
                seen += [(int(r), bytes(w).decode(), bool(k)) for r, w, k in zip(row, words.to_pylist(), np.append(linked, False))]
            want = []
            for r, t in enumerate(table):
                for piece in re.split("[.,;:!?\n-\r]", t):
                    w = piece.split()
                    want += [(r, x, i + 1 < len(w)) for i, x in enumerate(w)]
            assert seen == want


def test_samples_are_whole_pieces(spark):
    table = [("en", f"p{k} q{k}. r{k} s{k}\nt{k} u{k}") for k in range(500)] + [("en", "")] * 3
    texts = spark.createDataFrame(table, "lang string, text string")
    got = [p.strip() for r in texts.mapInArrow(c._sampling(0.5), "lang string, text string").collect() for p in re.split("[.\n]", r.text) if p.strip()]
    pieces = {p.strip() for _, t in table for p in re.split("[.\n]", t) if p.strip()}
    assert set(got) <= pieces and len(got) == len(set(got)) and 600 < len(got) < 900
