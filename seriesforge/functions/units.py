"""Units sniffed from captions and row labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words for currencies and scales in captions and labels.
CURRENCY_WORDS = {
    "USD": ["us$", "usd", "دولار"],
    "EGP": ["le", "egp", "جنيه"],
    "EUR": ["eur", "euro", "يورو"],
    "GBP": ["gbp", "استرليني"],
}
SCALE_WORDS = {
    "billion": ["bn", "billion", "مليار", "بالمليار"],
    "million": ["m", "mn", "mio", "mil", "mill", "million", "مليون", "بالمليون"],
}
PERCENT_WORDS = ["%", "percentage", "نسبة مئوية"]
CAPTION_WORDS = [
    ("thousand", ["(000", "thousand", "بالألف"]),
    ("index", ["index", "الرقم القياسي"]),
    ("number", ["number of", "in units", "عدد"]),
]


def _has_any(c: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | c.contains(w)
    return hit


def _ladder(text: Column, rungs: list[tuple[Column, str]]) -> Column:
    expr = F.lit(None).cast("string")
    for cond, unit in reversed(rungs):
        expr = F.when(cond, F.lit(unit)).otherwise(expr)
    return expr


def _flat(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))


def _vocabulary(words: dict[str, list[str]]) -> Column:
    return F.create_map(*[F.lit(x) for unit, spelled in words.items() for w in spelled for x in (w, unit)])


def _money(t: Column) -> Column:
    """The first currency word with a scale word beside it, on whichever side the language puts it."""
    plain = F.regexp_replace(t, r"\.", "")
    plain = F.regexp_replace(F.regexp_replace(plain, r"\bus (\$|doll?ars?\b)|\busdollars?\b", "us\\$"), r"\b(l e|eg p)\b", "le")
    words = F.regexp_extract_all(plain, F.lit(r"us\$|[a-z]+|[\x{600}-\x{6ff}]+"), F.lit(0))
    currency, scale = _vocabulary(CURRENCY_WORDS), _vocabulary(SCALE_WORDS)
    unit = lambda a, b: F.concat_ws(" ", currency[a], scale[b])
    beside = F.zip_with(
        words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))),
        lambda a, b: F.when(currency[a].isNotNull() & scale[b].isNotNull(), unit(a, b)).when(currency[b].isNotNull() & scale[a].isNotNull(), unit(b, a)),
    )
    known = "|".join(re.escape(w) for spelled in CURRENCY_WORDS.values() for w in spelled)
    # Most text names no currency and skips the reading of words.
    return F.when(plain.rlike(known), F.get(F.filter(beside, lambda u: u.isNotNull()), F.lit(0)))


def label_unit(label: Column) -> Column:
    t = _flat(label)
    return F.coalesce(_money(t), _ladder(t, [(_has_any(t, PERCENT_WORDS), "percent")]))


def caption_unit(caption: Column) -> Column:
    """Captions alone also say index, thousand or number."""
    t = _flat(caption)
    words = [(_has_any(t, PERCENT_WORDS), "percent")] + [(_has_any(t, w), unit) for unit, w in CAPTION_WORDS]
    return F.coalesce(_money(t), _ladder(t, words))


def sniff_unit(caption: Column, label: Column) -> Column:
    """The row label decides; the table caption is the fallback."""
    return F.coalesce(label_unit(label), caption_unit(caption))


def indent_level(label: Column) -> Column:
    """Depth of a row in its table: two leading blanks per level."""
    lead = F.length(label) - F.length(F.regexp_replace(label, r"^\s+", ""))
    return F.floor(lead / 2).cast("int")
