"""Column -> Column helpers (all JVM-side built-ins, no Python UDFs)."""

from quarry.functions.columns import (
    audit_loaded_at,
    calendar_month,
    calendar_year,
    epoch_millis_to_ntz,
    iso_week,
    last_token,
    lit_ntz,
    null_default,
    null_tokens,
    present,
    safe_index,
    strip_ws,
    text_to_date,
    to_day,
    upper_text,
)

__all__ = [
    "audit_loaded_at",
    "calendar_month",
    "calendar_year",
    "epoch_millis_to_ntz",
    "iso_week",
    "last_token",
    "lit_ntz",
    "null_default",
    "null_tokens",
    "present",
    "safe_index",
    "strip_ws",
    "text_to_date",
    "to_day",
    "upper_text",
]
