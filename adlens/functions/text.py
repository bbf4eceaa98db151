"""Message text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.functions.metrics import num_text

# Severity banners of the notification texts.
CRITICAL_BANNER = "🚨 CRITICAL ALERT 🚨\n\n"
WARNING_BANNER = "⚠️ WARNING ⚠️\n\n"


def text(*parts) -> Column:
    """Concatenate literal strings and Columns into one message."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def value_text(x) -> Column:
    """A metric as the reference prints it: ``0`` when missing, else the float text."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x.isNull(), F.lit("0")).otherwise(num_text(x))


def with_severity(subject, message, importance) -> tuple[Column, Column]:
    """Prefix subject and message by importance, case-insensitive.

    ``critical`` and ``warning`` get a banner; anything else is unchanged.
    """
    subject = F.col(subject) if isinstance(subject, str) else subject
    message = F.col(message) if isinstance(message, str) else message
    level = F.lower(F.col(importance) if isinstance(importance, str) else importance)
    new_subject = (F.when(level == "critical", F.concat(F.lit("CRITICAL: "), subject))
                   .when(level == "warning", F.concat(F.lit("WARNING: "), subject))
                   .otherwise(subject))
    new_message = (F.when(level == "critical", F.concat(F.lit(CRITICAL_BANNER), message))
                   .when(level == "warning", F.concat(F.lit(WARNING_BANNER), message))
                   .otherwise(message))
    return new_subject, new_message


def to_number(x) -> Column:
    """Text -> DOUBLE; text that is not a number -> null (never an error)."""
    x = F.col(x) if isinstance(x, str) else x
    return x.try_cast("double")
