"""Helpers for higher-order-function expressions.

Generators over computed arrays use the outer form (``explode_outer``, ``inline_outer``).
For the inner form Spark infers a filter that the array is not empty and pushes it below
the array's own computation, so a long expression is optimised and evaluated twice.
Where an array can be empty, the null row that the outer form gives it is dropped after.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda variable.

    Spark re-evaluates an expression each time a lambda body reads it, and
    the optimizer may inline a projected column into a lambda.  Binding the
    value through a one-element ``transform`` keeps it computed once, so
    array pipelines stay linear in the array length.
    """
    return F.transform(F.array(value), body)[0]


def record(**fields: Column) -> Column:
    """``named_struct`` with explicit field names.

    Inside lambdas an ``alias`` may be dropped during analysis (for example
    next to a generator), so structs built there name their fields
    explicitly.
    """
    args = []
    for name, value in fields.items():
        args += [F.lit(name), value]
    return F.named_struct(*args)
