"""Row keys turned into evenly spread, engine-independent hash text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from keepsake.functions.cells import column

HASH_DIGITS = 32


def key_hash(key: Sequence[str], seed: int) -> Column:
    """md5 of ``seed|key1|key2...`` as 32 hexadecimal digits.

    The digits are spread evenly and, having a fixed width, sort as text the way they sort as
    numbers. So a share of the rows is one text comparison, and any SQL engine can repeat it.
    """
    parts = [F.coalesce(column(c).cast("string"), F.lit("")) for c in key]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def share_bound(share: float) -> str:
    """The hash below which ``share`` of all hashes lie."""
    if not 0.0 <= share <= 1.0:
        raise ValueError(f"share must lie between 0 and 1, not {share}")
    if share == 1.0:
        return "g"  # sorts after every hexadecimal digit
    return f"{int(share * 2**32):08x}".ljust(HASH_DIGITS, "0")
