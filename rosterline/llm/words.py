"""Words of texts as UTF-8 bytes: stretches of chosen ASCII signs and of everything beyond ASCII, A-Z in small letters."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa

LETTERS = string.ascii_lowercase
ALPHANUMERIC = LETTERS + string.digits
RUN_BYTES = 1 << 20


def table(kept: str) -> bytes:
    """Translation of each byte: kept ASCII signs and bytes beyond ASCII stay, A-Z become small, the rest blanks."""
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    for sign in kept.encode():
        out[sign] = sign
    for sign in string.ascii_uppercase.encode():
        out[sign] = sign + 32
    return bytes(out)


def runs(data: bytes, of: bytes, size: int = RUN_BYTES) -> Iterator[list[bytes]]:
    """The words of a whole text in order, in lists of about ``size`` bytes, so that a long text is never one list."""
    data = data.translate(of)
    if len(data) <= size:
        yield data.split()
        return
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def encoded(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's texts in UTF-8, nulls as empty texts."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
