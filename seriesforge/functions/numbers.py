"""Numbers out of printed cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digit forms.
ARABIC_INDIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
ASCII_DIGITS = "0123456789"

# What counts as a figure. Dashes, dots, asterisks, N/A and blanks do not match, so
# they read as no figure.
_NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_BLANKS = " \t\n\r\f\x0b"
_NO_BREAK = "\u00a0"


def ascii_digits(c: Column) -> Column:
    return F.translate(c, ARABIC_INDIC_DIGITS, ASCII_DIGITS)


def _parse(c: Column) -> Column:
    return F.when(c.rlike(_NUMERIC), c.try_cast("double"))


def number(raw: Column | str, mode: str = "html") -> Column:
    """Printed text to double, null where no figure was printed.

    `html` drops separators, percent signs and no-break spaces. `sheet` also drops
    ordinary spaces and reads accounting negatives. Characters past the digits in
    the first list have no counterpart, so `translate` removes them.
    """
    c = F.col(raw) if isinstance(raw, str) else raw
    if mode == "html":
        s = F.translate(c, ARABIC_INDIC_DIGITS + ",%" + _NO_BREAK, ASCII_DIGITS)
        return _parse(F.trim(s, F.lit(_BLANKS)))
    if mode != "sheet":
        raise ValueError(f"unknown number mode {mode!r}")
    s = F.translate(c, ARABIC_INDIC_DIGITS + ",%" + _NO_BREAK + _BLANKS, ASCII_DIGITS)
    inner = F.substring(s, F.lit(2), F.length(s) - 2)
    return F.when(s.startswith("(") & s.endswith(")"), -_parse(inner)).otherwise(_parse(s))
