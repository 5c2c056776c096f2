"""Amount formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def format_amount(c: Column | str, style: str = "C") -> Column:
    """``C`` = dollars with sign, ``N`` = grouped number, both with two decimals."""
    c = col(c)
    digits = F.format_number(F.abs(c), 2)
    sign = F.when(c < 0, F.lit("-")).otherwise(F.lit(""))
    symbol = {"C": "$", "N": ""}[style or "C"]
    return F.concat(sign, F.lit(symbol), digits)
