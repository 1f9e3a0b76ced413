"""Compact byte codec of a pixel series, as Spark Column expressions.

Layout (big-endian, no header):
  bands     : unsigned 16-bit per value, 12 values per image, image order
  img_dates : unsigned 16-bit days since 1970-01-01 per image
  scl_vals  : unsigned 8-bit per image
  tiles/CDL : UTF-8 text, tiles joined by ','

Packing goes through hex text (``lpad(hex(v), w, '0')`` + ``unhex``), and
unpacking hexes the binary once and reads fixed-width slices, so both stay
in the JVM.  Values out of range raise (never wrap silently).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cropcube import constants as K
from cropcube.functions.hof import let


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _width_max(nbytes: int) -> int:
    return (1 << (8 * nbytes)) - 1


def pack_uint(values, nbytes: int = 2) -> Column:
    """array<int> -> BINARY of unsigned big-endian integers of ``nbytes`` each."""
    digits = 2 * nbytes
    top = _width_max(nbytes)

    def one(v):
        return F.when((v >= 0) & (v <= top), F.lpad(F.hex(v), digits, "0")).otherwise(
            F.raise_error(F.concat(F.lit(f"value out of unsigned {8 * nbytes}-bit range: "),
                                   v.cast("string"))))

    return F.unhex(F.array_join(F.transform(_c(values), one), ""))


def unpack_uint(data, nbytes: int = 2) -> Column:
    """BINARY of unsigned big-endian integers -> array<int> (empty for empty input).

    The binary is hexed once and cut into fixed-width groups by one regex
    pass (a separator after every group but the last), then each group is
    read as base 16.  Measured about 5x faster than slicing the hex text
    element by element and 1.4x faster than slicing the binary; splitting it as Latin-1
    characters and reading their codes takes the same time (4.8 million values in 1.45 s on
    two threads, either way).
    """
    digits = 2 * nbytes
    h = F.hex(_c(data))
    groups = F.split(F.regexp_replace(h, f"(.{{{digits}}})(?!$)", "$1,"), ",")
    values = F.transform(groups, lambda g: F.conv(g, 16, 10).cast("int"))
    return F.when(F.length(_c(data)) == 0, F.array().cast("array<int>")).otherwise(values)


def days_since_epoch(date_col) -> Column:
    return F.datediff(_c(date_col), F.lit(K.EPOCH).cast("date"))


def date_from_days(days) -> Column:
    return F.date_add(F.lit(K.EPOCH).cast("date"), _c(days))


def pack_dates(dates) -> Column:
    """array<date> -> BINARY u16 days since 1970-01-01 (covers up to 2149-06-06)."""
    return pack_uint(F.transform(_c(dates), days_since_epoch), 2)


def unpack_dates(data) -> Column:
    return F.transform(unpack_uint(data, 2), date_from_days)


def encode_text(text) -> Column:
    return F.encode(_c(text), "UTF-8")


def decode_text(data) -> Column:
    return F.decode(_c(data), "UTF-8")


def ints_to_text(values) -> Column:
    """array<int> -> "v1,v2,..." (the textual debug form)."""
    return F.array_join(F.transform(_c(values), lambda v: v.cast("string")), ",")


def unpack_matrix(data, num_images, width: int = 12) -> Column:
    """u16 BINARY -> array<array<int>> of ``num_images`` rows of ``width``.

    Raises when the byte length does not match ``width * num_images``.
    """
    n = _c(num_images).cast("int")

    def body(flat):
        rows = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                           lambda i: F.slice(flat, i * width + 1, width))
        return F.when(F.size(flat) == n * width, rows).otherwise(
            F.raise_error(F.concat(F.lit("packed length "), F.size(flat).cast("string"),
                                   F.lit(f" != {width} * num_images"))))

    return F.when(n == 0, F.array().cast("array<array<int>>")).otherwise(let(unpack_uint(data, 2), body))
