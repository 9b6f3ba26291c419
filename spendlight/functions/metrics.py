"""Money sums and the four ratio metrics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money is counted in units of 1e-8 dollar, fine enough for a single impression.
UNITS_PER_DOLLAR = 100_000_000
MONEY_TYPE = "decimal(28,8)"


def money_units(amount: str) -> str:
    """SQL of a double amount as whole units; one finer than a unit goes to the nearest."""
    return f"cast(rint({amount} * {UNITS_PER_DOLLAR}) as bigint)"


def off_grid(amount: str) -> str:
    """SQL that is true for an amount finer than a unit, which a sum would round."""
    return f"rint({amount} * {UNITS_PER_DOLLAR}) / {UNITS_PER_DOLLAR} <> {amount}"


def units_sum(units: str) -> Column:
    """Sum whole units and give dollars.

    Dollars and the rest are summed apart, so a group may hold 9e18 dollars and
    9e10 rows before a 64-bit sum overflows, which is an error and never wraps.
    """
    return F.expr(
        f"cast(cast(sum({units} div {UNITS_PER_DOLLAR}) as decimal(20,0))"
        f" + cast(sum({units} % {UNITS_PER_DOLLAR}) as decimal(19,0)) / {UNITS_PER_DOLLAR} as {MONEY_TYPE})"
    )


def money_sum(amount: str) -> Column:
    """Sum a double amount exactly, to 1e-8 of a dollar.

    The sums run over 64-bit whole units. That makes them independent of row
    order (a double sum is not) and keeps decimals, which Spark handles as
    objects beyond 18 digits, out of the per-row loop.
    """
    return units_sum(money_units(amount))


def ratio_sql(top: str, bottom: str, factor: int = 1, digits: int = 2) -> str:
    """SQL of ``round(factor * top / bottom, digits)``, half up, exact; NULL where bottom is not positive.

    Both operands get the type of money, which leaves the quotient ten decimals
    before the final rounding.
    """
    scaled = f"cast({factor} * {top} as {MONEY_TYPE})" if factor != 1 else f"cast({top} as {MONEY_TYPE})"
    quotient = f"case when {bottom} > 0 then {scaled} / cast({bottom} as {MONEY_TYPE}) end"
    return f"cast(round(cast({quotient} as decimal(38,10)), {digits}) as double)"


def ratio(
    numerator: str, denominator: str, *, factor: int = 1, digits: int = 2, on_zero: str = "null"
) -> Column:
    """``ratio_sql`` as a column; ``on_zero="zero"`` gives 0.0 where it is NULL."""
    if on_zero not in ("null", "zero"):
        raise ValueError(f"on_zero must be 'null' or 'zero', not {on_zero!r}")
    value = ratio_sql(numerator, denominator, factor, digits)
    return F.expr(f"coalesce({value}, 0.0D)" if on_zero == "zero" else value)


# metric -> (numerator, denominator, factor)
METRICS = {
    "roas": ("revenue_usd", "spend_usd", 1),
    "cac": ("spend_usd", "new_customers", 1),
    "conv_rate_pct": ("orders", "clicks", 100),
    "ctr_pct": ("clicks", "impressions", 100),
}


def with_metrics(
    df: DataFrame,
    metrics: list[str] | None = None,
    *,
    names: dict[str, str] | None = None,
    on_zero: str = "null",
) -> DataFrame:
    """Append ratio metrics. ``names`` maps a measure to its column in ``df``."""
    names = names or {}
    wanted = METRICS if metrics is None else {m: METRICS[m] for m in metrics}
    return df.withColumns(
        {
            metric: ratio(names.get(top, top), names.get(bottom, bottom), factor=factor, on_zero=on_zero)
            for metric, (top, bottom, factor) in wanted.items()
        }
    )
