"""Python functions on texts, a few rows at a time.

An Arrow batch holds 10,000 rows, and what is made of them is held until the
whole batch is done: with long texts, or several for each, that is hundreds of
MB in each worker. Plain UDFs see a hundred rows, so a worker's memory does not
depend on the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_row(change: Callable, kind: str, *columns: Column | str) -> Column:
    """``change`` of each row's values, as a column of this type."""
    return F.udf(change, kind, useArrow=False)(*columns)
