"""SimHash fingerprints of whole texts (used by the near-duplicate operator).

Words are the runs of characters other than U+0020 and U+0009-U+000D, after
A-Z has been lower-cased.  A shingle is ``n`` consecutive words joined by one
space; a text of fewer words has its whole word sequence as its only shingle,
a text without words (or a null text) has none and the fingerprint zero.
Shingles count as often as they occur; bit ``b`` of the fingerprint is set if
it is set in more than half of the shingles' XXH64 hashes (UTF-8, seed 42).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42
PIECE = 1 << 20          # bytes of text that are split into words at a time
_SPACES = b" \t\n\x0b\x0c\r"


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about ``PIECE`` bytes that end between two words."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in _SPACES:
            end += 1
        yield data[at:end]
        at = end


def fingerprint(text: str | None, n: int) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    digest = xxhash.xxh64_intdigest
    votes, total, carry = np.zeros(64, dtype=np.int64), 0, []
    for piece in _pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        words = carry + piece.split()
        if len(words) < n:
            carry = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends[:-1]]
        h = np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[n - 1:])),
                        dtype="<u8", count=len(words) - n + 1)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
        carry = words[len(words) - n + 1:]
    if not total:
        return digest(b" ".join(carry), SEED) if carry else 0
    return int(np.packbits(votes * 2 > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, n: int) -> Column:
    """The fingerprints of a text column as signed 64-bit integers."""
    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, n) for t in texts], dtype=np.uint64).view(np.int64))
    return simhash(text)
