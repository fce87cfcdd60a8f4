"""Expressions that steer the plan."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def once(value: Column) -> Column:
    """``value``, worked out once per row.

    A filter on a plain alias is moved below it and repeats its expression, for
    every use; parsing a JSON text many times costs more than the rest of a job.
    The output of a generator is not looked through.
    """
    return F.explode(F.array(value))
