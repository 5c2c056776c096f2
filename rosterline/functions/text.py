"""Text expressions with the comparison rules of a case-blind, blank-padded store."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the collation that ignores case and trailing blanks.
CASE_BLIND = "UTF8_LCASE_RTRIM"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_key(c: Column | str) -> Column:
    """Comparable form of a text key: case and trailing blanks do not count."""
    return F.lower(F.rtrim(col(c)))


def case_blind(c: Column | str) -> Column:
    """The same column, compared without regard to case or trailing blanks."""
    return F.collate(col(c), CASE_BLIND)


def same_text(a: Column | str, b: Column | str) -> Column:
    return text_key(a) == text_key(b)


def blank_to_null(c: Column | str) -> Column:
    """Blank text counts as missing."""
    c = col(c)
    return F.when(F.rtrim(c) != "", c)


def null_to_blank(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def default_if_blank(c: Column | str, default) -> Column:
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(blank_to_null(c), fallback)


def text_length(c: Column | str) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(col(c)))


def join_text(*parts: Column | str) -> Column:
    """Concatenate; plain strings are literals and one null part makes the result null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def append_line(existing: Column | str, addition: Column) -> Column:
    """Existing comment, a line break and the addition; only the addition when there is none."""
    existing = col(existing)
    return F.when(
        text_length(null_to_blank(existing)) > 0, F.concat(existing, F.lit("\r\n"), addition)
    ).otherwise(addition)


def version_part(c: Column | str, from_right: int) -> Column:
    """Dot-separated part counted from the right (1 = last), as an integer; null when absent."""
    parts = F.split(col(c), "[.]")
    part = F.when(F.size(parts) >= from_right, F.element_at(parts, -from_right))
    return part.try_cast("int")


def text_between(c: Column | str, marker: str, closing: str) -> Column:
    """Text right after ``marker`` (any case) up to ``closing``; null when the marker is absent."""
    c = col(c)
    at = F.locate(marker.lower(), F.lower(c))
    return F.when(at > 0, F.substring_index(F.substr(c, at + F.lit(len(marker))), closing, 1))


def decode(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Value look-up; values outside the mapping give ``default`` (null unless stated)."""
    c = col(c)
    result: Column | None = None
    for key, value in mapping.items():
        value = F.lit(value)
        result = F.when(c == F.lit(key), value) if result is None else result.when(c == F.lit(key), value)
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def merge_template(template: Column | str, fields: Mapping[str, Column]) -> Column:
    """Replace each ``{{NAME}}``; a null field makes the whole text null."""
    text = F.lit(template) if isinstance(template, str) else template
    for name, value in fields.items():
        text = F.replace(text, F.lit("{{" + name + "}}"), value.cast("string"))
    return text


def plural(count: Column | str, one: str, many: str) -> Column:
    return F.when(col(count) > 1, F.lit(many)).otherwise(F.lit(one))


def person_type(code_id: Column | str) -> Column:
    return F.substring(col(code_id), 1, 1)


def person_number(code_id: Column | str) -> Column:
    return F.substring(col(code_id), 2, 9)


def pad_person_id(c: Column | str, strip: bool = True) -> Column:
    """Person key from loosely typed text: pad to nine digits, then prefix the person letter."""
    c = col(c)
    if strip:
        c = F.translate(c, "- ", "")
    size = text_length(c)
    padded = F.when(size < 9, F.lpad(F.rtrim(c), 9, "0")).otherwise(c)
    return F.when(text_length(padded) == 9, F.concat(F.lit("P"), padded)).otherwise(padded)


# Name-format tokens and the person column each one prints.
NAME_TOKENS = {
    "PX": "PREFIX",
    "DN": "DISPLAY_NAME",
    "FN": "FIRST_NAME",
    "LP": "LAST_NAME_PREFIX",
    "LN": "LAST_NAME",
    "SX": "SUFFIX",
}


def display_name(pattern: str, columns: Mapping[str, Column]) -> Column:
    """Name from a ``|``-separated pattern of token + literal; an empty part drops its literal.

    ``columns`` maps tokens to columns; a token without a column prints nothing.
    The separators before an absent last part are trimmed.
    """
    parts = []
    for piece in pattern.split("|"):
        token, literal = piece[:2], piece[2:]
        if token not in NAME_TOKENS:
            raise ValueError(f"unknown name token {token!r}")
        if token in columns:
            value = columns[token]
            parts.append(
                F.when(text_length(null_to_blank(value)) > 0, F.concat(F.rtrim(value), F.lit(literal))).otherwise("")
            )
    return F.regexp_replace(F.concat(*parts), "[, ]+$", "") if parts else F.lit("")
