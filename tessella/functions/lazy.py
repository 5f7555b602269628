"""pandas UDFs that are made when they are first used, so that modules can be imported without a session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def lazy_udf(kind: str) -> Callable:
    def wrap(f: Callable) -> Callable[..., Column]:
        def call(*columns) -> Column:
            return F.pandas_udf(f, kind)(*columns)

        call.__name__, call.__doc__ = f.__name__, f.__doc__
        return call

    return wrap
