"""Quality rules against plain Python."""

import re
from collections import Counter, defaultdict

import duckdb

from tidemark.llm import oracles, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]", "0", line.lower())).strip(" ")


def judged(rows, min_docs, share):
    """(n_removed, kept, clean text) for each (text, host)."""
    split = [[normal(x) for x in (t or "").split("\n") if WORD.search(x)] for t, _ in rows]
    holders, texts = defaultdict(set), defaultdict(set)
    for lines, (_, h) in zip(split, rows):
        texts[h].add(tuple(lines))
        for line in lines:
            holders[h, line].add(tuple(lines))
    often = {k for k, v in holders.items() if len(v) > min_docs and len(v) > share * len(texts[k[0]])}
    out = []
    for lines, (t, h) in zip(split, rows):
        removed = sum(len(WORD.findall(x)) for x in lines if (h, x) in often)
        n_words, *_, repeats = base(t)
        failed = n_words < 10 or 100 * repeats > 20 * n_words
        left = n_words - removed
        clean = t if t is None else "\n".join(x for x in t.split("\n") if not WORD.search(x) or (h, normal(x)) not in often)
        out.append((removed, not failed and not (removed and (left < 10 or left < 0.2 * n_words)), clean))
    return out


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").toPandas()
    want = judged(list(zip(docs.text, docs.source)), 10, 0.001)
    got = {r.doc_id: r for r in quality.op1_quality(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for (i, text), verdict in zip(zip(docs.doc_id, docs.text), want):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(text), i
        assert (r.removed_words, r.kept, r.clean_text) == verdict, i


def test_whole_table_equals_its_sql(spark, sf_dir):
    rows = duckdb.sql(oracles.QUALITY.replace("from documents", f"from '{sf_dir}/documents.parquet'"))
    got = quality.op1_quality(spark, sf_dir).select(*rows.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rows.fetchall())


def test_shared_line_removed_and_depleted_rejected(spark):
    line = "subscribe to our letter now and share this page with all of your good friends"
    name = lambda i: "abc"[i // 10] + "klmnopqrst"[i % 10]  # noqa: E731  digits are all alike in normalised lines
    rows = [(i, f"unique {name(i)} start\n{line}\n" + " ".join(f"{name(i)}{name(k)}" for k in range(30)), "h", i) for i in range(30)]
    rows += [(100, line + "\nabc def", "h", 1), (101, line + "\nabc def", "other", 1), (102, None, None, 1), (103, "", "h", 1), (103, "", "h", 1)]
    docs = spark.createDataFrame([(i, t, "en", h, n, "x") for i, t, h, n in rows], DOCS)
    got = quality.quality_rules(docs, min_docs=10, share=0.1).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], *v) for r, v in zip(rows, judged([(t, h) for _, t, h, _ in rows], 10, 0.1)))
    assert Counter((r.doc_id, r.removed_words, r.kept, r.clean_text) for r in got) == want
    kept = {r.doc_id: r.kept for r in got}
    assert kept[0] and not kept[100] and kept[101] and not kept[102] and not kept[103]


def test_copies_are_left_alone(spark):
    text = "\n".join(" ".join(f"{a}{b}" for b in "klmnopqr") for a in "abcdefgh")
    docs = spark.createDataFrame([(i, text, "en", "h", 1, "x") for i in range(50)], DOCS)
    assert all(r.kept for r in quality.quality_rules(docs).collect())


def test_blocks_and_footers_are_removed_whole(spark):
    block = ["home news shop contact", "all rights reserved by the owner", "we use cookies on this page"]
    name = lambda i: "abc"[i // 10] + "klmnopqrst"[i % 10]
    body = lambda i: " ".join(f"{name(i)}{name(k)}" for k in range(30))
    texts = [f"{block[0]}\n{block[1]}\n{body(i)}\n{block[2]}" for i in range(30)]
    only = "\n".join([*block[:2], "two words", block[2]])
    docs = spark.createDataFrame([(i, t, "en", "h", 1, "x") for i, t in enumerate([*texts, only, *[body(0)] * 40])], DOCS)
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    words = sum(len(x.split()) for x in block)
    assert all(got[i].removed_words == words and got[i].kept for i in range(30))
    assert got[30].removed_words == words and not got[30].kept
    assert all(got[i].removed_words == 0 and got[i].kept for i in range(31, 71))


def test_host_of_boilerplate_is_rejected_and_clashing_columns(spark):
    """Two hundred documents of one menu and footer with four words of their own; columns named like inner or added ones."""
    menu = "home news sport weather business travel culture science food\nlogin register help contact imprint privacy terms jobs press about shop"
    foot = "all rights reserved by the owners of this site since the start of time and beyond"
    name = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    rows = [(i, f"{menu}\n{name(i)} {name(i + 7)} own text\n{foot}", "h", "mine", "host", "row", None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, n_words string, host string, row string, _lines string")
    got = quality.quality_rules(docs).collect()
    assert len(got) == 200 and all(not r.kept and not r.base_failed and r.n_words - r.removed_words == 4 for r in got)
    assert {(r.host, r.row, r["_lines"]) for r in got} == {("host", "row", None)}


def test_empty_table_and_long_text(spark):
    assert quality.quality_rules(spark.createDataFrame([], DOCS)).count() == 0
    long = " ".join(f"w{i % 70_001}" for i in range(150_000))
    got = quality.quality_rules(spark.createDataFrame([(1, long, "en", "h", 1, "x")], DOCS)).first()
    assert got.n_repeat_words == base(long)[-1]
