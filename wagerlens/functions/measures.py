"""Rates, conditional sums and the player risk ladder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
AVERAGE = "decimal(18,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent(num: Column | str, den: Column | str) -> Column:
    """num / den as a percentage with two digits, 0 unless den is positive.

    Whole numbers only. Rounding is half away from zero on integers, so the result does not
    depend on how num / den falls in binary. Pass decimals with scale 0 for sums that may
    outgrow a long.
    """
    num, den = _col(num), _col(den)
    half_up = F.call_function("div", F.abs(num) * 20000 + den, den * 2)
    return F.when(
        den > 0, F.signum(num.cast("double")) * half_up.cast("double") / F.lit(100.0)
    ).otherwise(F.lit(0.0))


def money_percent(num: Column | str, den: Column | str) -> Column:
    """percent() for amounts with two decimals."""
    cents = [(_col(c) * 100).cast("decimal(30,0)") for c in (num, den)]
    return percent(*cents)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as a double, NULL where den is 0."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def amount_if(kind: str, type_col: str = "transaction_type", amount: str = "amount") -> Column:
    """The amount on rows of one type, 0 elsewhere."""
    return F.when(F.col(type_col) == kind, F.col(amount)).otherwise(F.lit(0))


def average(total: Column | str, n: Column | str) -> Column:
    """Average from a sum and a count, NULL for no rows."""
    return F.try_divide(_col(total), _col(n)).cast(AVERAGE)


def risk_class() -> Column:
    """First rule that matches wins."""
    return (
        F.when((F.col("total_deposits") > 0) & (F.col("total_bets") == 0), "HIGH_RISK_NO_BETS")
        .when(F.col("total_withdrawals") > F.col("total_deposits"), "HIGH_RISK_OVER_WITHDRAWAL")
        .when(
            (F.col("active_days") <= 2) & (F.col("total_deposits") > 1000),
            "MEDIUM_RISK_NEW_HIGH_VALUE",
        )
        .otherwise("NORMAL")
    )
