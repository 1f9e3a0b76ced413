"""Class labels, lookups and one-hot encoding as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from cropcube import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_literal(mapping: dict) -> Column:
    """A MAP literal of a small, fixed dictionary (evaluated once per task)."""
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def lookup(mapping: dict, key) -> Column:
    """Value of ``key`` in a fixed dictionary; null when the key is absent."""
    return F.try_element_at(map_literal(mapping), _c(key))


def scl_name(code) -> Column:
    return lookup(K.SCL_NAMES, code)


def legend_name(label) -> Column:
    return lookup(dict(enumerate(K.LABEL_LEGEND)), label)


def base_label(cdl) -> Column:
    """Class name -> 0..6 before the vegetation override.

    Target crops map to 3..6 in legend order, other cultivated classes to 1,
    everything else (including a null class) to 0.
    """
    cdl = _c(cdl)
    expr = F.when(cdl.isin(K.OTHER_CULTIVATED), F.lit(1)).otherwise(F.lit(0))
    for i, name in reversed(list(enumerate(K.TARGET_CROPS))):
        expr = F.when(cdl == F.lit(name), F.lit(i + 3)).otherwise(expr)
    return F.coalesce(expr, F.lit(0))


def last_nonzero(values, n: int = 2) -> Column:
    """The last ``n`` non-zero entries of an int array (fewer when short)."""
    nz = F.filter(_c(values), lambda v: v != 0)
    return F.when(F.size(nz) <= n, nz).otherwise(F.slice(nz, -n, n))


def crop_label(cdl, scl_in_slot_order) -> Column:
    """Label 0..6 with the "No Crop Growing" override.

    A cultivated label becomes 2 when none of the last two non-zero SCL
    values of the bucketed series is vegetation (an empty list counts as
    "none", so an empty window with a crop class gives 2).
    """
    base = base_label(cdl)
    no_veg = F.forall(last_nonzero(scl_in_slot_order, 2), lambda v: v != K.SCL_VEGETATION)
    return F.when((base != 0) & no_veg, F.lit(K.LABEL_NO_CROP_GROWING)).otherwise(base)


def is_double_crop(cdl) -> Column:
    return F.coalesce(_c(cdl).contains("Dbl"), F.lit(False))


def one_hot(label, n: int = K.NUM_CLASSES) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.when(i == _c(label), F.lit(1.0)).otherwise(F.lit(0.0)))


def argmax(scores) -> Column:
    """0-based index of the largest entry; the lowest index wins ties."""
    s = _c(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")
