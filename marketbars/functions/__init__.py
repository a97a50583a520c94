"""Column expressions shared by the operators; all run inside the JVM."""

from marketbars.functions.columns import (
    add_steps,
    coerce_day,
    coerce_number,
    coerce_volume,
    duplicate_line,
    nan_to_null,
    null_double,
    strip_quotes,
    symbol_key,
    tidy_symbol,
)

__all__ = [
    "add_steps",
    "coerce_day",
    "coerce_number",
    "coerce_volume",
    "duplicate_line",
    "nan_to_null",
    "null_double",
    "strip_quotes",
    "symbol_key",
    "tidy_symbol",
]
