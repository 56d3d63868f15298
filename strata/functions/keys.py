"""Surrogate keys that any task can compute on its own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column) -> Column:
    """60 bits of the MD5 of the joined text, as BIGINT.

    The key depends on the row only, so it needs no global numbering and a re-run repeats it.
    """
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
