"""Arrow functions that are made when they are applied, so that modules import without a session."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow(result: str) -> Callable:
    """Decorates a function of Arrow arrays; it then takes and returns columns."""

    def wrap(f: Callable) -> Callable[..., Column]:
        @functools.wraps(f)
        def apply(*columns) -> Column:
            return F.arrow_udf(f, result)(*columns)

        return apply

    return wrap
