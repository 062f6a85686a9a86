"""Calendar keys and attributes as SQL expressions over a timestamp or date expression.

Keys use integer arithmetic on calendar fields where a format string would otherwise be
rendered and re-parsed for every reading."""

from __future__ import annotations


def date_key_sql(ts: str) -> str:
    """yyyyMMdd as int."""
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + dayofmonth({ts}) AS INT)"


def time_key_sql(ts: str) -> str:
    """HHmmss as int (leading zeros are lost, so 00:00:10 is 10)."""
    return f"CAST(hour({ts}) * 10000 + minute({ts}) * 100 + second({ts}) AS INT)"


def calendar_attributes_sql(day: str) -> list[str]:
    """The date dimension attributes of a DATE expression, in dimension order."""
    return [
        f"{date_key_sql(day)} AS date_key",
        f"{day} AS calendar_date",
        f"CAST(year({day}) AS INT) AS year",
        f"CAST(quarter({day}) AS INT) AS quarter",
        f"CAST(month({day}) AS INT) AS month",
        f"date_format({day}, 'MMMM') AS month_name",
        f"CAST(weekofyear({day}) AS INT) AS week_of_year",
        f"CAST(dayofmonth({day}) AS INT) AS day_of_month",
        f"CAST(dayofweek({day}) AS INT) AS day_of_week",
        f"date_format({day}, 'EEEE') AS day_name",
        f"dayofweek({day}) IN (1, 7) AS is_weekend",
    ]
