"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents
from tidemark.llm.spans import apart_from, beside, beside_columns, joined, labelled, replaced, with_matches

# The contract's patterns, with possessive repeats (where no match can give
# anything back) and look-behinds in place of retries inside a run, so that long runs
# of digits or letters cost time in proportion to their length.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Length of an IBAN by country code.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_LISTED = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
_CODES = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
#: A listed country's IBAN ends by its length, whatever follows after a space; of other codes the whole run is proposed.
#: A match takes in the first four characters only (group 1 is the proposal), so a false one hides nothing that begins inside it.
IBAN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})"
        rf"(?=((?:{_LISTED}|(?!{_CODES})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+)(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9-])"

BASE = ("email", "ip", "card", "phone")
#: Hundredths of a score: of the bare pattern, added by a passed checksum; context words and what they add.
KINDS = {
    "email": (80, 0, "e-?mail|mail|contact|write", 20),
    "ip": (50, 0, "ip|address|server|host|client|login", 30),
    "card": (40, 30, "card|visa|mastercard|amex|credit|debit|payment", 30),
    "phone": (50, 0, "phone|call|tel|mobile|cell|fax|contact", 40),
    "iban": (30, 50, "iban|account|konto|compte|cuenta|bank", 20),
    "ssn": (30, 0, "ssn|social security|tax id", 50),
    "local_phone": (30, 0, "phone|call|tel|mobile|cell|fax", 40),
}
ADDED = ("iban", "ssn", "local_phone")
#: Words that speak for another kind of number, and what they take away.
DOUBTS, DOUBT = "part|order|serial|invoice|version|item|sku|model|example|sample|test", 30
#: Score from which an added span counts, and code points on either side that are its context.
THRESHOLD, CONTEXT = 60, 50


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""
    return F.aggregate(
        F.split(F.reverse(digits), ""),
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("sum")),
        lambda acc, c: F.struct(
            (acc["i"] + 1).alias("i"),
            (acc["sum"] + F.when(acc["i"] % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int")))).alias("sum")),
        lambda acc: acc["sum"] % 10 == 0,
    )


def mod97(hit: Column) -> Column:
    """Whether an IBAN's check digits hold: first four characters last, A to Z as 10 to 35, remainder 1."""
    plain = F.replace(hit, F.lit(" "), F.lit(""))
    return F.aggregate(
        F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), ""),
        F.lit(0),
        lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
        lambda acc: acc == 1,
    )


def _ip_parts(hit: Column) -> Column:
    return F.forall(F.split(hit, r"\."), lambda part: F.length(F.ltrim(part, F.lit("0"))) <= 3) & F.forall(
        F.split(hit, r"\."), lambda part: F.coalesce(F.substring(F.ltrim(part, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255)


def _card(hit: Column) -> Column:
    return F.length(digits_of(hit)).between(13, 19) & luhn(digits_of(hit))


def _phone(hit: Column) -> Column:
    return F.length(digits_of(hit)).between(9, 15)


def with_scores(df: DataFrame, kind: str, text: str) -> DataFrame:
    """Add a score to the spans of ``_<kind>``, by context words in ``text`` near them and the doubts in ``_doubts``."""
    bare, checked, words, lift = KINDS[kind]
    spans = f"_{kind}"
    df = with_matches(df, "_words", text, rf"(?i)\b(?:{words})\b", F.size(spans) > 0)
    near = lambda r, points: f"if({r}.before >= {r}.span.start - {CONTEXT} or {r}.after <= {r}.span.end + {CONTEXT}, {points}, 0)"
    scored = f"named_struct('start', m.span.start, 'end', m.span.end, 'score', {bare + checked} + {near('m', lift)} - {near('n', DOUBT)})"
    return df.withColumn(spans, F.expr(f"zip_with({beside(spans, '_words')}, {beside(spans, '_doubts')}, (m, n) -> {scored})")).drop("_words")


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_email, n_ip, n_card, n_phone, ``base``, ``spans`` and ``scores``.

    ``base`` and ``spans`` are arrays of (kind, start, end) in code points, end exclusive.
    ``base`` has the contract's four kinds, by kind, then start. ``spans`` adds
    IBANs (mod-97 must hold), US social security and plain phone numbers whose score reaches ``THRESHOLD`` and
    that overlap no base span and no added span of a kind before theirs. A score starts at what the pattern and its checksum are
    worth, rises with a context word within 50 code points before or after the
    span, and falls with a word that speaks for another kind of number; ``scores`` has that of each of ``spans``, in hundredths.
    Base spans stay whatever their score. Null and empty texts have no spans; texts of any length are
    scanned whole. Rows stay as many as they are. All columns of ``docs`` stay, but for those with an added name.
    """
    return beside_columns(docs, text, _with_personal_data, (*[f"n_{k}" for k in BASE], "base", "spans", "scores"))


def _with_personal_data(docs: DataFrame, text: str) -> DataFrame:
    whole = "_text"
    df = docs.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    t = F.col(whole)
    df = df.withColumn("_digits", t.rlike("[0-9]"))
    df = with_matches(df, "_email", whole, EMAIL, F.contains(t, F.lit("@")))
    df = with_matches(df, "_ip", whole, IP, F.col("_digits") & t.rlike(r"[0-9]\.[0-9]+\.[0-9]"), _ip_parts)
    df = with_matches(df, "_card", whole, CARD, F.col("_digits"), _card)
    df = with_matches(df, "_phone", whole, PHONE, F.col("_digits") & F.contains(t, F.lit("+")), _phone)
    df = with_matches(df, "_iban", whole, IBAN, F.col("_digits"), mod97, ahead=4)
    df = with_matches(df, "_ssn", whole, SSN, F.col("_digits") & F.contains(t, F.lit("-")))
    df = with_matches(df, "_local_phone", whole, LOCAL_PHONE, F.col("_digits"))
    df = with_matches(df, "_doubts", whole, rf"(?i)\b(?:{DOUBTS})\b", F.expr(" or ".join(f"size(_{k}) > 0" for k in KINDS)))
    for k in KINDS:
        df = with_scores(df, k, whole)
    place = lambda k: f"transform(_{k}, x -> named_struct('start', x.start, 'end', x.end))"
    taken = [place(k) for k in BASE]
    for k in ADDED:
        df = df.withColumn("_taken", F.expr(f"concat({', '.join(taken)})")).withColumn(f"_{k}", F.expr(f"filter(_{k}, x -> x.score >= {THRESHOLD})"))
        df = df.withColumn(f"_{k}", apart_from(f"_{k}", "_taken"))
        taken = ["_taken", place(k)]
    return df.withColumns({
        "base": F.expr(f"concat({', '.join(labelled(f'_{k}', k) for k in BASE)})"),
        "spans": F.expr(f"concat({', '.join(labelled(f'_{k}', k) for k in KINDS)})"),
        "scores": F.expr(f"concat({', '.join(f'transform(_{k}, x -> x.score)' for k in KINDS)})"),
        **{f"n_{k}": F.size(f"_{k}").cast("long") for k in BASE},
    }).drop(whole, "_digits", "_doubts", "_taken", *[f"_{k}" for k in KINDS])


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, as in ``[EMAIL]``; null texts stay null."""
    columns = docs.columns
    return (
        _with_personal_data(docs.select([F.col(c).alias(f"in_{i}") for i, c in enumerate(columns)]), f"in_{columns.index(text)}")
        .withColumn(f"in_{columns.index(text)}", replaced(f"in_{columns.index(text)}", "spans", "concat('[', upper(kind), ']')"))
        .select([F.col(f"in_{i}").alias(c) for i, c in enumerate(columns)])
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", *[f"n_{k}" for k in BASE],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), F.array_join("scores", ",").alias("scores"))
