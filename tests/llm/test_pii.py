"""Personal data against plain Python."""

import hashlib
import random
import re
import time

from tidemark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(x) <= 255 for x in hit.split(".")),
        "card": 13 <= len(d) <= 19 and luhn(d),
        "phone": 9 <= len(d) <= 15,
    }[kind]


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m.group())]


def check(got, text):
    want = base(text)
    assert [(x.kind, x.start, x.end) for x in got.base] == want, text[:80] if text else text
    assert [got[f"n_{k}"] for k in pii.BASE] == [sum(x[0] == k for x in want) for k in pii.BASE]


EDGE = [
    None, "", "a@b.c_d@e.f", "x@y.z@w.v", "..@a.b", "a@b", "a@b.", "é a.b+c%d@x-1.y.z, q", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 00000000000000000000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 411111111111111", "+1 (555) 123-4567. +123456789012345678 ++12 345 678 9", "+1" + "2" * 200, "9" * 50_000, "a" * 50_000 + "@", "a." * 30_000, "1-" * 20_000,
    "ññ x@y.zz +49 30 1234567 4111111111111111 10.0.0.1\n" * 40,
]


def test_edge_texts(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(EDGE)], "doc_id long, text string, base string")
    for r in pii.personal_data(docs).collect():
        check(r, EDGE[r.doc_id])


def test_whole_table(spark, sf_dir):
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = pii.op10_pii(spark, sf_dir).collect()
    assert len(got) == len(docs)
    found = 0
    for r in got:
        want = base(docs[r.doc_id])
        found += len(want)
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in want) for k in pii.BASE)
    assert found > 20


def test_added_kinds_need_checksum_or_context(spark):
    texts = {
        1: "pay to IBAN DE89 3704 0044 0532 0130 00 today", 2: "pay to IBAN DE88 3704 0044 0532 0130 00 today", 3: "code GB82WEST12345698765432",
        4: "my ssn is 219-09-9999", 5: "part 219-09-9999", 6: "call me: (555) 123-4567", 7: "see (555) 123-4567", 8: "219-09-9999 is a social security number",
        9: "order GB82WEST12345698765432", 10: "ssn " + "x" * 60 + " 219-09-9999", 11: "serial 219-09-9999 (not an ssn)",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: {(x.kind, texts[r.doc_id][x.start:x.end], n) for x, n in zip(r.spans, r.scores)} for r in pii.personal_data(docs).collect()}
    assert got[1] == {("iban", "DE89 3704 0044 0532 0130 00", 100)} and got[2] == set() and got[3] == {("iban", "GB82WEST12345698765432", 80)}
    assert got[4] == {("ssn", "219-09-9999", 80)} and got[5] == set() and got[6] == {("local_phone", "(555) 123-4567", 70)} and got[7] == set()
    assert got[8] == {("ssn", "219-09-9999", 80)}, "context after the span"
    assert got[9] == got[10] == got[11] == set(), "doubts lower the score; context is near only"


IBAN = {"DE": 22, "GB": 22, "FR": 27}


def mod97(hit):
    plain = hit.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def added(text):
    """Spans that the method adds, by rules written out anew: (kind, start, end, score)."""
    found, taken = [], [(s, e) for _, s, e in base(text)]
    proposals = {
        "iban": [(m.start(1), m.start(1) + len(h)) for m in re.finditer(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}))", text)
                 for h in [next((text[m.start(1):m.start(1) + k] for k in range(15, 46) if len(text[m.start(1):m.start(1) + k].replace(" ", "")) == IBAN.get(m.group(1)[:2], 0)), "")]
                 if h and re.fullmatch(r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9])+", h) and not re.match("[A-Za-z0-9]", text[m.start(1) + len(h):]) and mod97(h)],
        "ssn": [m.span() for m in re.finditer(pii.SSN, text)], "local_phone": [m.span() for m in re.finditer(pii.LOCAL_PHONE, text)],
    }
    for kind, spans in proposals.items():
        bare, checked, words, lift = pii.KINDS[kind]
        near = lambda w, s, e: any((m.start() < s and m.end() >= s - 50) or (m.start() >= s and m.start() <= e + 50) for m in re.finditer(rf"(?i)\b(?:{w})\b", text))
        new = [(kind, s, e, bare + checked + lift * near(words, s, e) - 30 * near(pii.DOUBTS, s, e)) for s, e in spans]
        new = [x for x in new if x[3] >= 60 and not any(x[1] < e and s < x[2] for s, e in taken)]
        found, taken = found + new, taken + [(s, e) for _, s, e, _ in new]
    return found


def test_added_spans_and_scores_equal_brute_force(spark):
    rnd = random.Random(8)
    parts = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "GB82WEST12345698765431", "FR1420041010050500013M02606", "219-09-9999", "(555) 123-4567", "555-123-4567", "+1 555 123 4567",
             "a@b.cc", "10.0.0.1", "4111 1111 1111 1111", "ssn", "call", "phone", "iban", "bank", "order", "part", "sample", "tel 219-09-9999", "word", "é", "x" * 30, "-", "(", "\n"]
    texts = [" ".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 25))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    n = 0
    for r in pii.personal_data(docs).collect():
        check(r, r.text)
        want = added(r.text)
        n += len(want)
        assert [(x.kind, x.start, x.end, k) for x, k in list(zip(r.spans, r.scores))[len(r.base):]] == want, r.text
    assert n > 300


def test_many_spans_take_no_square_of_time(spark):
    text = "é a@b.cc 219-09-9999 ssn " * 20_000
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    began = time.time()
    out = pii.masked(docs).first().text
    assert out == "é [EMAIL] [SSN] ssn " * 20_000 and time.time() - began < 60


def test_iban_ends_by_its_length(spark):
    spaced, compact, other = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    texts = [(f"ñ IBAN {iban} {after}", [iban]) for iban in (spaced, compact) for after in ("Amount due", "Please pay", "250 EUR", "BIC COBADEFFXXX", "COBADEFFXXX", "A", "", "€")]
    texts += [(f"é NR12 {spaced} Please AT12 {spaced} DE12 {other} {compact} NOW", [spaced, spaced, other, compact]), (f"{other} DE88 3704 0044 0532 0130 00 X", [other]),
              (f"{compact}X {compact}1 x{compact}", []), ("AB12 " * 10_000 + spaced + " Z", [spaced])]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    for r in pii.personal_data(docs).collect():
        assert [r.text[x.start:x.end] for x in r.spans if x.kind == "iban"] == texts[r.doc_id][1], r.text[:80]
    assert pii.masked(docs).filter("doc_id = 0").first().text == "ñ IBAN [IBAN] Amount due"


def test_masked(spark):
    docs = spark.createDataFrame([(1, "é a@b.cc and +1 (555) 123-4567!", "s"), (2, None, "s"), (3, "plain", "s")], "doc_id long, text string, spans string")
    out = pii.masked(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "é [EMAIL] and [PHONE]!", 2: None, 3: "plain"}
    assert pii.masked(docs.limit(0)).count() == 0


def test_columns_named_like_inner_ones_stay(spark):
    docs = spark.createDataFrame([(1, "a@b.cc", "a", "b", "c", "d", 5)], "doc_id long, Text string, _text string, _digits string, in_0 string, SPANS string, n_ip int")
    got = pii.personal_data(docs)
    assert got.columns == ["doc_id", "Text", "_text", "_digits", "in_0", "n_email", "n_ip", "n_card", "n_phone", "base", "spans", "scores"]
    r = got.first()
    assert (r.doc_id, r.Text, r["_text"], r["_digits"], r["in_0"], r.n_email, r.n_ip) == (1, "a@b.cc", "a", "b", "c", 1, 0)
