"""Secret scans against plain Python, and held-out accuracy of the models."""

import hashlib
import math
import random
import re
import string
from collections import Counter

from tidemark.llm import secrets

PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def base(text):
    keep = {"assign": lambda m: len(m.group(2)) >= 6, "access": lambda m: len(m.group()) >= 20, "hex": lambda m: len(m.group()) >= 24}
    found = [(m.start(), i, k, m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if keep[k](m)]
    return [(k, s, e) for s, _, k, e in sorted(found)]


EDGE = [
    None, "", "secret:token:abcdefgh", "token=password=abcdef", "TOKEN = 'AbC123' api_key:x apikey: \"zzzzzz\"", "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " AKIAAKIA" + "C" * 30,
    "é password=é abcdef0123456789abcdef0123 " + "f" * 24 + "g" + "0" * 23, "0123456789abcdef" * 5000, "token" * 10_000, "password=" + "a" * 50_000, "passwd  :  x", "secret = " * 3000,
]


def test_edge_texts(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(EDGE)], "doc_id long, text string, spans string")
    for r in secrets.scan_secrets(docs, [0.0] * secrets.SIZE**2).collect():
        assert [(x.kind, x.start, x.end) for x in r.base] == base(EDGE[r.doc_id]), r.doc_id


def test_whole_table(spark, sf_dir):
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = secrets.op6_secrets(spark, sf_dir).collect()
    assert len(got) == len(docs)
    total = 0
    for r in got:
        want = base(docs[r.doc_id])
        total += len(want)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in secrets.BASE] == [sum(x[0] == k for x in want) for k in secrets.BASE]
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(r.spans.split(",")) or not want
    assert total > 5


def test_models_on_held_out_strings(spark, sf_dir):
    rnd = random.Random(5)
    fake = lambda n: "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(n))
    words = ["get", "user", "name", "file", "path", "open", "list", "count", "index", "value", "parse", "table", "config", "buffer"]
    name = lambda: "_".join(rnd.choice(words) for _ in range(5)) + str(rnd.randint(1, 99))
    samples = [(1, fake(32)) for _ in range(400)] + [(0, name()) for _ in range(400)]
    model = secrets.train(spark.createDataFrame(samples, "label int, value string"))
    held_out = [(1, fake(rnd.randint(20, 40))) for _ in range(200)] + [(0, name()) for _ in range(200)]
    scored = spark.createDataFrame(held_out, "label int, value string").withColumn("s", secrets.looks_random(secrets.F.col("value"), model)).collect()
    assert sum(r.s == bool(r.label) for r in scored) >= 0.98 * len(scored)
    short = [(1, fake(rnd.randint(14, 19))) for _ in range(200)] + [(1, "".join(rnd.choice(string.ascii_letters) for _ in range(20))) for _ in range(200)]
    scored = spark.createDataFrame(short, "label int, value string").withColumn("s", secrets.looks_random(secrets.F.col("value"), model)).collect()
    assert sum(r.s for r in scored) >= 0.95 * len(scored), "short ones, and letters only"
    text = f"see {fake(30)} and {name()} here"
    spans = secrets.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first().spans
    assert [(x.kind, text[x.start:x.end]) for x in spans] == [("random", text[4:34])]


def trained(samples):
    """Transition scores by plain counting."""
    code = lambda c: secrets.ALPHABET.find(c) if c in secrets.ALPHABET else len(secrets.ALPHABET)
    n, logs = len(secrets.ALPHABET) + 1, []
    for label in (0, 1):
        pairs = Counter((code(a), code(b)) for k, v in samples if k == label for a, b in zip(v, v[1:]))
        single = [1 + sum(pairs[a, b] for a in range(n)) for b in range(n)]
        row = [sum(pairs[a, b] for b in range(n)) for a in range(n)]
        logs.append({(a, b): math.log((pairs[a, b] + 5 * single[b] / sum(single)) / (row[a] + 5)) for a in range(n) for b in range(n)})
    return lambda v: sum(logs[1][code(a), code(b)] - logs[0][code(a), code(b)] for a, b in zip(v, v[1:]))


def test_random_spans_equal_brute_force(spark, sf_dir):
    """Models and spans of the whole table, counted and scored by plain Python from the same labelled rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    samples = secrets.labelled_samples(docs).collect()
    assert {r.label for r in samples} == {0, 1}
    score, random_spans = trained([tuple(r) for r in samples]), 0
    rnd = random.Random(9)
    noise = lambda n: "".join(rnd.choice(string.ascii_letters + string.digits + "+/") for _ in range(n))
    texts = dict(docs.collect()) | {-k: f"é {noise(k)} x password={noise(k)} {'0a' * k} {noise(k)[:30].lower()} y_{noise(12)}==" for k in range(8, 48)}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in secrets.scan_secrets(table, secrets.train(secrets.labelled_samples(docs))).collect():
        covered, want = base(r.text), []
        for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}={0,2}", r.text or ""):
            total, n = score(m.group()), len(m.group()) - 1
            if re.search("[A-Za-z]", m.group()) and total >= 15 - 1e-3 and total / n > 0.5 and not any(m.start() < e and s < m.end() for _, s, e in covered):
                want.append((m.start(), m.end()))
        random_spans += len(want)
        assert [(x.start, x.end) for x in r.spans if x.kind == "random"] == want, r.doc_id
    assert random_spans > 40


def test_clean_texts_have_no_random_strings(spark, sf_dir):
    got = secrets.op6_secrets(spark, sf_dir).filter("spans like '%random%'").count()
    assert got <= 5


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.scan_secrets(docs, secrets.train(secrets.labelled_samples(docs))).count() == 0


def test_columns_named_like_inner_ones_stay(spark):
    docs = spark.createDataFrame([(1, "token=abcdef", "a", "b", "c", "d", 5)], "doc_id long, Text string, _text string, _candidates string, in_0 string, SPANS string, n_hex int")
    got = secrets.scan_secrets(docs, [0.0] * secrets.SIZE**2)
    assert got.columns == ["doc_id", "Text", "_text", "_candidates", "in_0", "n_assign", "n_access", "n_hex", "base", "spans"]
    r = got.first()
    assert (r.doc_id, r.Text, r["_text"], r["_candidates"], r["in_0"], r.n_assign, r.n_hex) == (1, "token=abcdef", "a", "b", "c", 1, 0)
