"""Exact amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the type of every amount.
MONEY = "decimal(19,4)"


def extended_price(
    quantity: Column | str, price: Column | str, discount: Column | str, sql_type: str = MONEY
) -> Column:
    """quantity x (price - discount), the discount being an amount per unit.

    An amount too large for ``sql_type``, or a step on the way too large for any
    decimal, becomes NULL instead of failing the job.
    """
    quantity, price, discount = (
        F.col(c) if isinstance(c, str) else c for c in (quantity, price, discount)
    )
    return F.try_multiply(quantity, F.try_subtract(price, discount)).try_cast(sql_type)
