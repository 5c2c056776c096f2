"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their score.

Only built-in expressions on one pass over the rows, no exchange. Kinds: e-mail addresses, IPv4 addresses (parts up to
255), card numbers (13 to 19 digits, Luhn), phone numbers (9 to 15 digits after a plus), and bank account numbers
(IBAN, mod 97) beyond the base. A match that its check refuses is dropped and its text is not tried again. Loops of the
patterns are possessive and start only where a run starts, so that long runs of digits or letters take time in
proportion to their length and no stack.

A confirmed span scores its kind's prior; a context word of its kind in the ``reach`` characters before it adds
``BONUS``, a contrary word (version, order number, ...) takes as much; the score stays within 0 and 1.

Null texts count as empty and give no spans and the digest of the empty text. Rows are independent of each other:
repeated rows give repeated results, an empty table an empty one. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm import base, spans

# The patterns, and the words that raise or lower a score.
PATTERNS = {
    # A run of name letters is entered at its start or where the last match ended.
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Lengths of bank account numbers by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Exactly as long as the country's numbers, so that what follows after a blank is not taken in.
PATTERNS["iban"] = r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()) + r")(?![A-Za-z0-9])"
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9}
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "host", "address", "server", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
}
CONTRARY = ("version", "release", "order no", "invoice no", "serial", "isbn")
BONUS = 0.2
BASE_KINDS = ("email", "ip", "card", "phone")


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits is right."""
    turned = F.split(F.reverse(digits), "")

    def step(acc, d):
        doubled = d.cast("int") * 2
        return F.struct((acc["sum"] + F.when(acc["odd"], F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(d.cast("int"))).alias("sum"), (~acc["odd"]).alias("odd"))

    return F.aggregate(turned, F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd")), step, lambda acc: acc["sum"] % 10 == 0)


def mod97(value: Column) -> Column:
    """Whether an IBAN (capitals and digits, no blanks) has remainder 1 modulo 97."""
    turned = F.split(F.concat(F.substring(value, 5, 64), F.substring(value, 1, 4)), "")

    def step(acc, ch):
        code = F.ascii(ch)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(turned, F.lit(0), step, lambda acc: acc == 1)


def alone(text: Column, span: Column) -> Column:
    """Whether no letter or digit stands beside a span."""
    beside = F.concat(F.substring(text, span["start"], F.when(span["start"] > 0, 1).otherwise(0)), F.substring(text, span["end"] + 1, F.lit(1)))
    return ~beside.rlike("[A-Za-z0-9]")


def confirmed(kind: str, text: Column, span: Column) -> Column:
    value = span["value"]
    if kind == "ip":
        # Compared as text without leading zeros: a part may be longer than any number type.
        significant = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(significant(p)) <= 3) & (F.lpad(F.right(significant(p), F.lit(3)), 3, "0") <= "255"))
    if kind == "card":
        return F.length(digits_of(value)).between(13, 19) & luhn(digits_of(value))
    if kind == "phone":
        return F.length(digits_of(value)).between(9, 15)
    if kind == "iban":
        return alone(text, span) & mod97(F.replace(value, F.lit(" "), F.lit("")))
    return F.lit(True)


def scored(kind: str, text: Column, span: Column, reach: int) -> Column:
    start = F.greatest(span["start"] - reach, F.lit(0))
    near = F.lower(F.substring(text, start + 1, span["start"] - start))
    has = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(near, w))
    score = F.lit(PRIOR[kind]) + F.when(has(CONTEXT[kind]), BONUS).otherwise(0.0) - F.when(has(CONTRARY), BONUS).otherwise(0.0)
    return F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 3)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 40) -> DataFrame:
    """doc_id, text and for each kind an array of (start, end, value, score)."""
    df = base.keyed_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    df = df.select("doc_id", "text", *[spans.matches(F.col("text"), p).alias(f"m_{k}") for k, p in PATTERNS.items()])
    df = df.select("doc_id", "text", *[spans.placed(F.col("text"), F.col(f"m_{k}"), p).alias(k) for k, p in PATTERNS.items()])

    def kept(kind):
        return F.filter(F.col(kind), lambda s: confirmed(kind, F.col("text"), s))

    df = df.select("doc_id", "text", *[kept(k).alias(k) for k in PATTERNS])

    def with_score(kind):
        return F.transform(F.col(kind), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), scored(kind, F.col("text"), s, reach).alias("score")))

    return df.select("doc_id", "text", *[with_score(k).alias(k) for k in PATTERNS])


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of what ``scan`` returns, n_iban and the highest score."""
    labels = {k: spans.labelled(F.col(k), i, k, "kind") for i, k in enumerate(PATTERNS)}
    own = [labels[k] for k in BASE_KINDS]
    scores = F.concat(*[F.transform(F.col(k), lambda s: s["score"]) for k in PATTERNS])
    return scanned.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(spans.written(own).cast("binary"), 256).alias("base_sha256"), spans.written(list(labels.values())).alias("spans"),
        F.size("iban").cast("long").alias("n_iban"), F.array_max(scores).alias("top_score"),
    )
