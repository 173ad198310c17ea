"""Text forms: search form, display form, readable form, page text."""

from __future__ import annotations

import html
import re
import unicodedata
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from seriesforge.functions.numbers import ARABIC_INDIC_DIGITS, ASCII_DIGITS

# Letters folded together for search, and marks dropped.
FOLD_FROM = "أإآٱىةؤئ"
FOLD_TO = "اااايهوي"
TASHKEEL = "[ً-ْٰـ]"

# Every Unicode space, spelled out: a plain class is matched faster than a property, and the far ones are
# looked at only inside their range.
SPACES = r"[ \t\n\x0b\f\r\x{85}\x{a0}[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]+"

# Index token limits and stop words.
TOKEN = "[a-z0-9؀-ۿ]+"
MIN_TERM = 2
MAX_TERM = 28
STOP_WORDS = [
    "the", "and", "for", "with", "that", "this", "from", "was", "were", "has",
    "have", "had", "its", "their", "which", "been", "are", "not", "but", "all",
    "any", "may", "can", "will", "shall", "such", "into", "than", "then",
    "also", "other", "these", "those", "there", "over", "under", "per", "out",
    "one", "two", "new", "end", "due", "each", "more", "most", "some", "only",
    "في", "من", "على", "الى", "عن", "مع", "هذا", "هذه", "التي", "الذي", "كما",
    "ذلك", "بين", "قد", "ما", "لا", "أن", "ان", "او", "الا", "به", "له",
]

# Control characters dropped and the private-use ranges.
CONTROL = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f\\ufffd]"
PRIVATE_USE = "[\\ue000-\\uf8ff\\x{f0000}-\\x{ffffd}\\x{100000}-\\x{10fffd}]"
DAMAGED_AT = 0.15
MAX_PAGE_CHARS = 20_000


@arrow_udf(T.StringType())
def nfkc(text: pa.Array) -> pa.Array:
    # Most text is ASCII or composed already; only the rest is rewritten.
    return pa.array(
        [
            t if t is None or t.isascii() else unicodedata.normalize("NFKC", t)
            for t in text.to_pylist()
        ],
        type=pa.string(),
    )


@arrow_udf(T.StringType())
def unescape_entities(text: pa.Array) -> pa.Array:
    return pa.array(
        [t if t is None or "&" not in t else html.unescape(t) for t in text.to_pylist()],
        type=pa.string(),
    )


# A reference closed by its semicolon; `&amp` is read without one too.
CLOSED_REFERENCE = re.compile(r"&amp;?|&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


def _closed(m: re.Match) -> str:
    name = m[1]
    if name is None:
        return "&"
    return html.unescape(m[0]) if name[0] == "#" or f"{name};" in html5 else m[0]


@arrow_udf(T.StringType())
def unescape_closed(text: pa.Array) -> pa.Array:
    """Entities decoded but for those cut off before their semicolon, which stay as printed."""
    return pa.array(
        [t if t is None or "&" not in t else CLOSED_REFERENCE.sub(_closed, t) for t in text.to_pylist()],
        type=pa.string(),
    )


def plain_ascii(c: Column) -> Column:
    return F.length(c) == F.octet_length(c)


def composed(c: Column) -> Column:
    """Compatibility form; ASCII text is in it already and is not sent to Python."""
    return F.when(plain_ascii(c), c).otherwise(nfkc(F.when(~plain_ascii(c), c)))


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(c, SPACES, " ")


def fold(c: Column) -> Column:
    """Search folding after compatibility normalisation; ASCII text has no marks and no letters to fold."""
    return F.when(plain_ascii(c), F.lower(F.trim(collapse_space(c)))).otherwise(fold_shown(F.trim(collapse_space(F.regexp_replace(c, TASHKEEL, "")))))


def shown_form(c: Column) -> Column:
    """Text whose positions are those of its search form: only letters differ."""
    return F.replace(F.trim(collapse_space(F.regexp_replace(nfkc(c), TASHKEEL, ""))), F.lit("İ"), F.lit("I"))


def fold_shown(c: Column) -> Column:
    # Every letter and digit that is folded stands in the Arabic block.
    return F.lower(F.when(script_arabic(c), F.translate(c, FOLD_FROM + ARABIC_INDIC_DIGITS, FOLD_TO + ASCII_DIGITS)).otherwise(c))


def search_form(c: Column, compose: bool = True) -> Column:
    """Index and query form. `compose=False` leaves out NFKC for text known to be composed."""
    return fold(composed(c) if compose else c)


def fold_text(s: str) -> str:
    """`search_form` of a query string, on the driver."""
    t = re.sub(TASHKEEL, "", unicodedata.normalize("NFKC", s))
    t = t.translate(str.maketrans(FOLD_FROM + ARABIC_INDIC_DIGITS, FOLD_TO + ASCII_DIGITS))
    return re.sub(r"\s+", " ", t).strip().lower()


def stop_words() -> list[str]:
    """The stop list in folded form, so that it meets folded text."""
    return sorted({fold_text(w) for w in STOP_WORDS})


def display_form(c: Column) -> Column:
    t = F.regexp_replace(c, "\n{3,}", "\n\n")
    t = F.regexp_replace(t, "[ \t]+", " ")
    return F.regexp_replace(t, r"^[ \n\r\t\f\x0b]+|[ \n\r\t\f\x0b]+$", "")


def language(c: Column) -> Column:
    """Language by script share."""
    arabic = F.regexp_count(c, F.lit("[؀-ۿ]"))
    latin = F.regexp_count(c, F.lit("[A-Za-z]"))
    return (
        F.when(arabic > latin * 1.5, F.lit("ar"))
        .when(latin > arabic * 1.5, F.lit("en"))
        .when((arabic > 0) | (latin > 0), F.lit("mixed"))
        .otherwise(F.lit("unknown"))
    )


def readable(c: Column, compose: bool = True) -> Column:
    """struct(text, lost): publishable text and the share that was private-use glyphs, both null where there is no text."""
    t = F.regexp_replace(nfkc(c) if compose else c, CONTROL, "")
    lost = F.regexp_count(t, F.lit(PRIVATE_USE))
    share = F.when(F.length(t) > 0, lost / F.length(t)).when(F.length(t) == 0, F.lit(0.0))
    text = F.trim(collapse_space(F.regexp_replace(t, PRIVATE_USE, " ")))
    return F.struct(text.alias("text"), share.cast("double").alias("lost"))


def indexable(t: Column, least: int = MIN_TERM, most: int | None = MAX_TERM) -> Column:
    """Whether one raw token is a term of the index; without an upper length where `most` is None."""
    return (
        (F.length(t) >= least) & (F.lit(True) if most is None else F.length(t) <= most)
        & ~t.isin(stop_words())
        & (t.between("a", "z") | ~t.rlike(r"^\p{Nd}+$"))
    )


def tokens(folded: Column) -> Column:
    """Array of index terms of folded text, in order."""
    return F.filter(F.regexp_extract_all(folded, F.lit(TOKEN), F.lit(0)), lambda t: indexable(t))


def clean_markup(c: Column, unescape: bool = True, cut_off: bool = True) -> Column:
    """Tags out, entities decoded, whitespace collapsed.

    An entity cut off before its semicolon (`&quot`) is decoded as HTML does, or kept as printed without `cut_off`.
    """
    t = F.regexp_replace(c, "<[^>]+>", " ")
    if unescape:
        t = unescape_entities(t) if cut_off else unescape_closed(t)
    return F.trim(collapse_space(t))


def page_text(c: Column, unescape: bool = True, cut_off: bool = True) -> Column:
    """Body text of a page: between the header and the footer, without code or trailer; entities as in `clean_markup`."""
    head = F.instr(c, "</header>")
    foot = F.instr(c, "<footer")
    start = F.when(head > 1, head).otherwise(F.lit(1))
    stop = F.when(foot > 1, foot).otherwise(F.length(c) + 1)
    body = F.substring(c, start, F.greatest(stop - start, F.lit(0)))
    body = F.regexp_replace(body, "(?s)<script.*?</script>", " ")
    body = F.regexp_replace(body, "(?s)<style.*?</style>", " ")
    text = clean_markup(body, unescape, cut_off)
    return F.trim(F.regexp_replace(text, "This page was last updated.*$", ""))


def script_arabic(c: Column) -> Column:
    return c.rlike("[؀-ۿ]")
