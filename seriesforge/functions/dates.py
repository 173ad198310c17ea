"""Periods, fiscal years and header tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesforge.functions.numbers import ascii_digits

# English month names.
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

DATE_KINDS = (None, "period_range", "mon_year", "mon_year_text", "dmy_text")


def _lookup(pairs: dict[str, int]) -> Column:
    flat: list[Column] = []
    for k, v in pairs.items():
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)


def _month_spellings() -> dict[str, int]:
    out: dict[str, int] = {}
    for i, name in enumerate(MONTH_NAMES, start=1):
        out[name] = i
        out[name[:3]] = i
    out["sept"] = 9
    return out


def _month3(c: Column) -> Column:
    return _lookup({m[:3]: i for i, m in enumerate(MONTH_NAMES, start=1)})[F.lower(c)]


def month_from_name(c: Column) -> Column:
    """Month number of a full English month name."""
    return _lookup({m: i for i, m in enumerate(MONTH_NAMES, start=1)})[F.lower(c)]


def safe_date(y: Column, m: Column, d: Column) -> Column:
    """year, month, day to DATE; null for a day that does not exist."""
    dash = F.lit("-")
    return F.concat(F.lpad(y.cast("string"), 4, "0"), dash, m.cast("string"), dash, d.cast("string")).try_cast("date")


def dmy(raw: Column | str) -> Column:
    """Strict `d/m/yyyy` prefix."""
    c = F.col(raw) if isinstance(raw, str) else raw
    # One pass over the text: without a match every part is empty and there is no such date.
    p = r"(?s)^(?:(\d{1,2})/(\d{1,2})/(\d{4}))?.*"
    return F.regexp_replace(F.trim(ascii_digits(c)), p, "$3-$2-$1").try_cast("date")


def period(raw: Column | str, kind: str | None = None) -> Column:
    """A printed date in one of the five layouts, to DATE."""
    if kind not in DATE_KINDS:
        raise ValueError(f"unknown date kind {kind!r}")
    c = F.col(raw) if isinstance(raw, str) else raw
    s = F.trim(ascii_digits(c))
    if kind == "period_range":
        return dmy(F.trim(F.substring_index(s, "-", -1)))
    if kind in ("mon_year", "mon_year_text"):
        sep = r"\s*-\s*" if kind == "mon_year" else r"\s+"
        hit = F.regexp_extract(s, r"^[A-Za-z]{3}\w*" + sep + r"\d{4}", 0)
        return safe_date(F.right(hit, F.lit(4)), _month3(F.substring(hit, 1, 3)), F.lit(1))
    if kind == "dmy_text":
        hit = F.regexp_extract(s, r"^\d{1,2}\s+[A-Za-z]{3}\w*\s+\d{4}", 0)
        return safe_date(
            F.right(hit, F.lit(4)),
            _month3(F.regexp_extract(hit, "([A-Za-z]{3})", 1)),
            F.regexp_extract(hit, r"^(\d{1,2})", 1),
        )
    return dmy(s)


def month_token(v: Column | str) -> Column:
    """Month number of a header cell, whatever punctuation it carries."""
    c = F.col(v) if isinstance(v, str) else v
    # A cell without letters, as most figures are, is not looked up.
    return F.when(F.lower(c) != F.upper(c), _lookup(_month_spellings())[F.lower(F.regexp_replace(c, "[^A-Za-z]", ""))])


def year_token(v: Column | str, compat: bool = False) -> Column:
    """First 19xx/20xx in the cell. Digit boundaries are required unless `compat`."""
    c = F.col(v) if isinstance(v, str) else v
    p = r"((?:19|20)\d{2})" if compat else r"(?<!\d)((?:19|20)\d{2})(?!\d)"
    s = ascii_digits(c)
    return F.when(s.contains("19") | s.contains("20"), F.regexp_extract(s, p, 1).try_cast("int"))


def fiscal_token(v: Column | str) -> Column:
    """`2004/2005` or `2005/06` to struct(end_year, label); null when it spans more than a year."""
    c = F.col(v) if isinstance(v, str) else v
    s = ascii_digits(c)
    p = r"\b((?:19|20)\d{2})\s*/\s*((?:19|20)?\d{2})\b"
    start = F.regexp_extract(s, p, 1).try_cast("int")
    tail = F.regexp_extract(s, p, 2)
    end = F.when(F.length(tail) == 4, tail.try_cast("int")).otherwise(start + 1)
    label = F.concat(F.lit("FY"), start, F.lit("/"), F.substring(end.cast("string"), 3, 2))
    return F.when(
        c.contains("/") & start.isNotNull() & (end >= start) & (end - start <= 1),
        F.struct(end.alias("end_year"), label.alias("label")),
    )


def quarter_token(v: Column | str) -> Column:
    c = F.col(v) if isinstance(v, str) else v
    return F.when(c.contains("Q") | c.contains("q"), F.regexp_extract(ascii_digits(c), r"(?i)^\s*Q\s*([1-4])\s*$", 1).try_cast("int"))


def month_end(y: Column, m: Column) -> Column:
    return F.last_day(safe_date(y, m, F.lit(1)))


def fiscal_year(d: Column | str) -> Column:
    """Fiscal year label of a date; the year runs 1 July to 30 June."""
    c = F.col(d) if isinstance(d, str) else d
    start = F.year(c) - F.when(F.month(c) >= 7, 0).otherwise(1)
    return F.format_string("FY%d/%02d", start, (start + 1) % 100)


def fiscal_window_end(month_name: Column, fy_start: Column, fy_end: Column) -> Column:
    """Last day of `month` inside fiscal year start/end."""
    m = month_from_name(month_name)
    return month_end(F.when(m >= 7, fy_start).otherwise(fy_end), m)


def day_number(d: Column | str) -> Column:
    """Days since 1970-01-01, the numeric key that RANGE frames need."""
    c = F.col(d) if isinstance(d, str) else d
    return F.unix_date(c)
