"""Money in exact decimals; doubles would change cents between engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderwell.schema import ORDER_VALUE

PERCENT = "cast(0.01 as decimal(3,2))"


def order_value(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """quantity x price x (1 - discount / 100), to the cent, halves away from 0.

    Null when the result does not fit the column, so that one absurd row cannot
    stop a load.
    """
    exact = quantity * unit_price * (F.lit(100) - discount_pct) * F.expr(PERCENT)
    return F.round(exact, 2).try_cast(ORDER_VALUE)


def half_up_mean(total: Column, count: Column) -> Column:
    """``total / count`` to the cent, halves away from zero, null for no rows.

    Worked in whole cents: a decimal division is itself rounded, and rounding
    its result again could move a cent.
    """
    cents = F.abs(total * 100).cast("decimal(36,0)")
    doubled = (cents * 2 + count).cast("decimal(38,0)")
    whole = F.call_function("div", doubled, (count * 2).cast("decimal(38,0)"))
    mean = whole.cast("decimal(20,0)") * F.expr(PERCENT)
    return F.when(count > 0, F.when(total < 0, -mean).otherwise(mean))
