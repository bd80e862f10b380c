"""Money text, exact means and integer cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Two-decimal money as a long, so that folds add integers."""
    return (amount * 100).cast("long")


def from_cents(amount: Column, precision: int = 16) -> Column:
    return (amount.cast(f"decimal({precision},0)") / 100).cast(f"decimal({precision},2)")


def mean(total: Column, rows: Column) -> Column:
    """``total / rows`` in double; NULL on no rows, also in ANSI mode."""
    return total.cast("double") / F.nullif(rows, F.lit(0).cast("long"))


def money_text(amount: Column, width: int) -> Column:
    """``$`` then the grouped amount right-aligned to ``width``; a wider amount is shown in full."""
    text = F.regexp_replace(F.format_number(amount, 2), r"^(-?)0\.", "$1.")
    return F.concat(F.lit("$"), F.when(F.length(text) < width, F.lpad(text, width, " ")).otherwise(text))
