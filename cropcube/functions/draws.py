"""Seeded draws that any engine can repeat.

A draw is the number in the first 8 hex digits of the MD5 of its parts joined by
'|': uniform, the same for any order of rows, free of overflow for any key, and
different for each seed and epoch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(*parts, seed: int = 0, epoch: int = 0) -> Column:
    """A number from 0 to 2**32 - 1 for the parts (columns or values; none may be null)."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(str(epoch)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def draw_sql(*parts: str, seed: int = 0, epoch: int = 0) -> str:
    """The same draw as DuckDB SQL."""
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', '{epoch}', {', '.join(parts)})), 1, 8) AS BIGINT)"
