"""Helpers for expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside nested lambdas.

    Catalyst may inline an expression into a lambda, which would evaluate it again for
    each element; a one-element array binds it to a lambda variable instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
