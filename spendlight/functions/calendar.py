"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: str) -> Column:
    """Date as the integer yyyymmdd (20240131)."""
    return F.expr(f"year({day}) * 10000 + month({day}) * 100 + day({day})")


def calendar_columns(day: str) -> dict[str, Column]:
    """The attributes of the date dimension, by name. Monday is day 0 of the
    week; weeks are ISO 8601."""
    sql = {
        "year": f"year({day})",
        "month": f"month({day})",
        "quarter": f"quarter({day})",
        "day_of_month": f"day({day})",
        "day_of_week": f"weekday({day})",
        "day_name": f"date_format({day}, 'EEEE')",
        "is_weekend": f"if(weekday({day}) >= 5, 1, 0)",
        "month_name": f"date_format({day}, 'MMMM')",
        "week_of_year": f"weekofyear({day})",
    }
    return {name: F.expr(text) for name, text in sql.items()}
