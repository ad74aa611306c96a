"""Small expression helpers shared by the column-function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, fn) -> Column:
    """Bind ``value`` to a lambda variable so ``fn`` can use it many times.

    Column expressions are trees: using a sub-expression twice copies it (and evaluates
    it twice). Wrapping it in a one-element array and transforming that array binds it
    to a variable instead, keeping nested expressions linear in size.
    """
    return F.get(F.transform(F.array(value), fn), 0)
