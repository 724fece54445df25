"""Reproducible pseudo-random columns derived from a row key.

``rand()`` restarts from the physical row order, so a recomputed partition may
draw other numbers. A digest of the key depends on the row alone: a lost
executor, another partition count or another engine gives the same value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 32


def key_digest(keys: Sequence[str], seed: int = 0) -> Column:
    """md5 of ``seed-key1-key2-…`` as 32 hex digits."""
    if not keys:
        raise ValueError("a digest needs at least one key column")
    parts = [F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)]
    return F.md5(F.concat_ws("-", *parts))


def key_word(keys: Sequence[str], word: int, seed: int = 0) -> Column:
    """The ``word``-th (0..3) 32-bit unsigned integer of the digest."""
    if not 0 <= word <= 3:
        raise ValueError("an md5 digest holds the words 0 to 3")
    digits = F.substring(key_digest(keys, seed), 8 * word + 1, 8)
    return F.conv(digits, 16, 10).cast("long")
