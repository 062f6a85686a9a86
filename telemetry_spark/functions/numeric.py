"""Rounding that gives the same digits on every engine and every summation order."""

from __future__ import annotations


def round_half_up_sql(value: str, digits: int) -> str:
    """Round a double expression through decimal(28,10), half up, and return a double.

    Plain ``round(avg(x), n)`` on a double depends on the order partial sums were added
    in, so an exact tie such as 4.9375 can come out either way.  Snapping to 10 decimals
    first removes the summation noise, and the decimal round is exact.
    """
    return f"CAST(round(CAST({value} AS DECIMAL(28,10)), {int(digits)}) AS DOUBLE)"
