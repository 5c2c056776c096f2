"""Secrets in texts: three fixed patterns, and strings whose letters are too evenly mixed to be words.

Only built-in expressions on one pass over the rows, no exchange. Candidate strings are runs of 20 or more letters,
digits and ``+/_=-``. A window of 20 characters slides over each; the counts of its symbols are kept up to date from the
one that enters and the one that leaves, and with them the sum of c * log2(c) in whole 2^-20ths, so that the entropy
log2(20) - sum/20 is exact to that grain at every place. Two character classes are judged each by its own alphabet and
threshold: hex digits, and base64 with its URL form. Windows must lie in the class whole; base64 windows must hold a
digit, a capital and a small letter. A candidate that an allow-list pattern matches gives no entropy span; the fixed
patterns are never suppressed. A span runs from the first to the last window above the threshold.

Null texts count as empty and give no spans and the digest of the empty text. Very long texts are scanned whole, in memory in
proportion to the text. Spans that begin together are listed in the order of the kinds; spans may overlap. Rows are independent of each other:
repeated rows give repeated results, an empty table an empty one. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm import base, spans

# The patterns of the base kinds.
ASSIGN_HEAD = r"""(?i)(?=[pstaPSTA])(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]++"
ASSIGN_VALUE = "^" + ASSIGN_HEAD + r"([A-Za-z0-9+/_.=-]+)$"
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
ALLOWED = (r"(?i)example|placeholder|changeme|dummy", r"^[0-9=_+/-]+$", r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", r"(.)\1{7}")
CLASSES = {"hexrun": ("0123456789abcdef", 3.0), "b64run": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 3.9)}
WINDOW = 20
GRAIN = 1 << 20


def weight(count: int) -> int:
    """count * log2(count) in whole grains."""
    return round(count * math.log2(count) * GRAIN) if count > 1 else 0


def most_weight(threshold: float, window: int) -> int:
    """The largest sum of weights of a window whose entropy still reaches ``threshold``."""
    return math.floor((math.log2(window) - threshold) * window * GRAIN)


def entropy_spans(candidates: Column, alphabet: str, threshold: float, window: int, mixed: bool) -> Column:
    """For each candidate (struct of start, end, value) the span of its windows above the threshold."""
    weights = F.array(*[F.lit(weight(c)).cast("long") for c in range(window + 2)])
    folded = (lambda c: F.translate(c, "-_", "+/")) if mixed else F.lower
    # Symbols of a candidate as places in the alphabet, 0 for others.
    coded = F.transform(candidates, lambda c: F.struct(c["start"].alias("start"), F.transform(F.split(folded(c["value"]), ""), lambda ch: F.instr(F.lit(alphabet), ch)).alias("codes")))

    def slide(c):
        first = F.struct(
            F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("inside"),
            F.lit(0).alias("small"), F.lit(0).alias("capital"), F.lit(0).alias("digit"), F.lit(0).alias("first"), F.lit(0).alias("last"),
        )

        def count_at(acc, code):
            return F.when(code > 0, F.get(acc["counts"], code - 1)).otherwise(0)

        def step(acc, i):
            enters = F.element_at(c["codes"], i)
            leaves = F.when(i > window, F.element_at(c["codes"], F.greatest(i - window, F.lit(1)))).otherwise(0)

            def change(low, high):
                return enters.between(low, high).cast("int") - leaves.between(low, high).cast("int")

            same = enters == leaves
            more = F.when(same | (enters == 0), 0).otherwise(F.get(weights, count_at(acc, enters) + 1) - F.get(weights, count_at(acc, enters)))
            less = F.when(same | (leaves == 0), 0).otherwise(F.get(weights, count_at(acc, leaves) - 1) - F.get(weights, count_at(acc, leaves)))
            counts = F.when(same, acc["counts"]).otherwise(F.transform(acc["counts"], lambda x, k: x + (k + 1 == enters).cast("int") - (k + 1 == leaves).cast("int")))
            moved = {"sum": acc["sum"] + more + less, "inside": acc["inside"] + change(1, 64)}
            moved |= {"small": acc["small"] + change(27, 52), "capital": acc["capital"] + change(1, 26), "digit": acc["digit"] + change(53, 62)}
            good = (moved["inside"] == window) & (moved["sum"] <= most_weight(threshold, window))
            if mixed:
                good = good & (moved["small"] > 0) & (moved["capital"] > 0) & (moved["digit"] > 0)
            bounds = [F.when(good & (acc["first"] == 0), i).otherwise(acc["first"]).alias("first"), F.when(good, i).otherwise(acc["last"]).alias("last")]
            return F.struct(counts.alias("counts"), *[v.alias(k) for k, v in moved.items()], *bounds)

        def span(acc):
            ends = [(c["start"] + acc["first"] - window).alias("start"), (c["start"] + acc["last"]).alias("end"), F.lit("").alias("value")]
            return F.when(acc["last"] > 0, F.struct(*ends))

        return F.aggregate(F.sequence(F.lit(1), F.size(c["codes"])), first, step, span)

    return F.filter(F.transform(coded, slide), lambda s: s.isNotNull())


def _scanned(df: DataFrame, carry: list[str], allowed: tuple[str, ...], window: int) -> DataFrame:
    """``df`` (a column text without nulls) with an array of spans for each kind; ``carry`` are the columns to keep."""
    if window > 20:
        raise ValueError("a window is 20 characters at most: no candidate is shorter")
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "candidate": CANDIDATE}
    df = df.select(*carry, *[spans.matches(F.col("text"), p).alias(f"m_{k}") for k, p in patterns.items()])
    df = df.select(*carry, *[spans.placed(F.col("text"), F.col(f"m_{k}"), p).alias(k) for k, p in patterns.items()])

    def suppressed(c):
        out = F.lit(False)
        for pattern in allowed:
            out = out | c["value"].rlike(pattern)
        return out

    df = df.withColumns({
        "assign": F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN_VALUE, 1)) >= 6),
        "candidate": F.filter("candidate", lambda c: ~suppressed(c)),
    })
    found = [F.when(F.size("candidate") > 0, entropy_spans(F.col("candidate"), a, t, window, kind == "b64run")).otherwise(spans.none()).alias(kind) for kind, (a, t) in CLASSES.items()]
    return df.select(*carry, "assign", "access", "hex", *found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: tuple[str, ...] = ALLOWED, window: int = WINDOW) -> DataFrame:
    """doc_id, text and for each kind an array of (start, end, value): assign, access, hex, hexrun, b64run."""
    df = base.keyed_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return _scanned(df, ["doc_id", "text"], allowed, window)


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of what ``scan`` returns."""
    kinds = ["assign", "access", "hex", *CLASSES]
    labels = [spans.labelled(F.col(k), i, k) for i, k in enumerate(kinds)]
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in kinds]
    return scanned.select("doc_id", *counts[:3], F.sha2(spans.written(labels[:3]).cast("binary"), 256).alias("base_sha256"), spans.written(labels).alias("spans"), *counts[3:])


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]", allowed: tuple[str, ...] = ALLOWED, window: int = WINDOW) -> DataFrame:
    """``docs`` with the spans of all kinds replaced by ``mark`` in the text; overlapping spans get one mark.

    All rows and columns stay; a null text stays null.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = _scanned(docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), row.alias("row")), ["text", "row"], allowed, window)
    kinds = ["assign", "access", "hex", *CLASSES]
    cuts = F.array_sort(F.concat(*[F.transform(F.col(k), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in kinds]))
    found = found.select("text", "row", cuts.alias("cuts"))

    def step(acc, s):
        kept = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], kept).otherwise(acc["out"]).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("cuts", first, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    text = F.when(F.size("cuts") > 0, clean).otherwise(F.col("row")[text_col])
    return found.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
