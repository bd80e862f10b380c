"""Masks for personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_mail_user(mail: Column) -> Column:
    """Hide everything before the first ``@``; a value without ``@`` is hidden whole."""
    return F.regexp_replace(mail, "^[^@]+", "xxxxxx")


def mask_digits(text: Column) -> Column:
    return F.translate(text, "0123456789", "X" * 10)


def mask_card(number: Column) -> Column:
    """Keep the last four characters of a card number."""
    return F.when(
        number.isNotNull(),
        F.concat(F.repeat(F.lit("X"), F.greatest(F.length(number) - 4, F.lit(0))), F.substring(number, -4, 4)),
    )
