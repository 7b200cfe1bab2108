"""Exact duplicates against a dictionary of texts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup


def brute(rows, keep, normal=lambda t: t):
    groups = {}
    for d, t in rows:
        groups.setdefault(normal(t or ""), []).append(d)
    out = []
    for t, ids in groups.items():
        known = [d for d in ids if d is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        out += [(d, best, len(ids), hashlib.sha256(t.encode()).hexdigest()) for d in ids]
    return sorted(out, key=repr), len(groups)


def rows():
    """Copies, null and empty texts, texts alike for more than a sort key's start, a long one, repeated ids and rows without any."""
    rnd = random.Random(12)
    texts = ["", None, "a", "a\0", "b" * 40 + "1", "b" * 40 + "2", "ж" * 9, "x" * 300_000, "x" * 300_000 + "y", " a", "A"]
    out = [(k, "the hot text") for k in range(400)] + [(None, "the hot text")] * 5 + [(None, "nobody's")] * 3 + [(7, "the hot text")] * 4
    return out + [(rnd.choice([None, rnd.randrange(1000)]), rnd.choice(texts)) for _ in range(600)]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("bucket_rows", [8, 100_000])
def test_same_as_brute_force(spark, keep, bucket_rows):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(7)
    found = exact_dedup.exact_duplicates(docs, keep=keep, bucket_rows=bucket_rows)
    got = found.collect()
    want, groups = brute(rows(), keep)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept}) and all(r.doc_id == r.keep_id for r in kept)
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(rows(), key=repr)


def test_groups_that_splitters_cut(spark):
    """Ten rows a range: the hot text lies in many ranges, and its size is that of all of them."""
    docs = spark.createDataFrame([(k, "hot" if k % 3 else f"t{k // 9}") for k in range(3000)], "doc_id long, text string")
    keys = docs.select(exact_dedup.sort_key(F.col("text"), F.col("doc_id")))
    bounds = exact_dedup.splitters(keys, 10)
    assert len(bounds) == 511 and max(map(len, bounds)) == 64
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(docs, bucket_rows=10).collect()}
    assert all(got[k] == ((1, 2000) if k % 3 else (k // 9 * 9, 3 if k // 9 < 333 else 1)) for k in range(3000))


def test_normal_form_other_columns_and_names(spark):
    docs = spark.createDataFrame([(2, "A b", "x", 1, 5), (1, "a  B", "y", 2, 6), (3, None, "z", 3, 7)], "doc_id long, text string, kept string, content int, row int")
    found = exact_dedup.exact_duplicates(docs, normal=lambda t: F.lower(F.regexp_replace(t, " +", " ")))
    assert found.columns == ["doc_id", "text", "content", "row", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((r.doc_id, r.text, r.content, r.row, r.keep_id, r.group_size, r.kept) for r in found.collect()) == [
        (1, "a  B", 2, 6, 1, 2, True), (2, "A b", 1, 5, 1, 2, False), (3, None, 3, 7, 3, 1, True)]
    kept = exact_dedup.keep_one(docs, normal=lambda t: F.lower(F.regexp_replace(t, " +", " ")))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    with pytest.raises(ValueError):
        exact_dedup.exact_duplicates(docs, keep="any")


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
