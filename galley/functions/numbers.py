"""Money and ratios.

Money is held as a decimal so that sums do not depend on the order of the rows, and
turned into a double only in report columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
_WIDE = T.DecimalType(28, 4)


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def whole(amount: Column) -> Column:
    return amount.cast("bigint")


def exact_ratio(total: Column, count: Column, digits: int) -> Column:
    """``total / count`` rounded half away from zero; NULL when ``count`` is 0.

    ``count`` may be an amount of money as well.
    """
    quotient = F.try_divide(total.cast(_WIDE), count.cast(_WIDE))
    return F.round(quotient, digits).cast("double")
