"""Identifiers, slugs, families and shards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Id prefixes of each published partition.
PART_FAMILIES = {
    "fx": ["EG.FX."],
    "rates": ["EG.IBK.", "EG.CONIA.", "EG.RATE."],
    "govt": ["EG.TB."],
    "prices": ["EG.CPI."],
    "external": ["EG.RES.", "EG.EXT."],
    "excel": ["EG.XL."],
}

# Short codes of the spreadsheet archive's categories.
CATEGORY_CODES = {
    "CBE": "CBE",
    "Domestic Debt": "DDEBT",
    "External Debt": "XDEBT",
    "GDP": "GDP",
    "Interest Rates": "IRATE",
    "Investments": "INV",
    "Net Foreign Direct Investment": "FDI",
    "Tourism": "TOUR",
    "Foreign Trade": "TRADE",
    "Stocks": "STOCK",
    "Banking Surveys": "BANK",
    "BOP": "BOP",
    "Inflation": "PRICE",
    "State Budget": "BUDGET",
}

# Extensions kept for a stored document.
FILE_EXTENSIONS = [".pdf", ".xlsx", ".xls", ".doc", ".docx", ".zip"]

SHARDS = 256


def literal_map(pairs: dict[str, str]) -> Column:
    flat: list[Column] = []
    for k, v in pairs.items():
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)


def key_slug(c: Column) -> Column:
    """Letters and digits only, upper case."""
    return F.upper(F.regexp_replace(c, "[^A-Za-z0-9]+", ""))


def label_slug(c: Column, limit: int = 44) -> Column:
    s = F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]+", "_")
    s = F.upper(F.trim(s, F.lit("_")))
    return F.trim(F.substring(s, 1, limit), F.lit("_"))


def url_slug(c: Column, keep: int = 90) -> Column:
    s = F.trim(F.lower(c), F.lit("/"))
    s = F.trim(F.regexp_replace(s, "[^a-z0-9]+", "-"), F.lit("-"))
    return F.right(s, F.lit(keep))


def document_id(url: Column) -> Column:
    return F.substring(F.sha1(url.cast("binary")), 1, 16)


def label_tail(c: Column) -> Column:
    """Slug of a row label; a short digest where the label has no Latin letters."""
    s = label_slug(c)
    digest = F.concat(F.lit("R"), F.upper(F.substring(F.sha1(c.cast("binary")), 1, 8)))
    return F.when(F.length(s) > 0, s).otherwise(digest)


def from_pattern(pattern: str, **parts: Column) -> Column:
    """Fill `{name}` holes of an id pattern with columns."""
    out: list[Column] = []
    rest = pattern
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if head:
            out.append(F.lit(head))
        out.append(parts[name])
    if rest:
        out.append(F.lit(rest))
    return F.concat(*out)


def part_family(series_id: Column) -> Column:
    expr = F.lit("other")
    for name, prefixes in reversed(PART_FAMILIES.items()):
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | series_id.startswith(p)
        expr = F.when(hit, F.lit(name)).otherwise(expr)
    return expr


def part_family_of(series_id: str) -> str:
    """The partition of one id, worked out on the driver so partitions prune."""
    for name, prefixes in PART_FAMILIES.items():
        if series_id.startswith(tuple(prefixes)):
            return name
    return "other"


def category_code(c: Column) -> Column:
    return F.coalesce(literal_map(CATEGORY_CODES)[c], label_slug(c, 8))


def category_family(c: Column) -> Column:
    return F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit(" "), F.lit("_"))


def shard(term: Column, shards: int = SHARDS) -> Column:
    """djb2 (seed 5381, multiplier 33, 32 bits) of the term, modulo `shards`."""
    codes = F.transform(F.split(term, ""), lambda ch: F.ascii(ch).cast("bigint"))
    h = F.aggregate(
        codes,
        F.lit(5381).cast("bigint"),
        lambda acc, code: (acc * F.lit(33) + code).bitwiseAND(F.lit(4294967295)),
    )
    return (h % F.lit(shards)).cast("int")


def shard_of_text(term: str, shards: int = SHARDS) -> int:
    """The same shard for a query term, worked out on the driver so partitions prune."""
    h = 5381
    for ch in term:
        h = (h * 33 + ord(ch)) % (1 << 32)
    return h % shards


def file_extension(url: Column) -> Column:
    """Stored extension of a document url, `.html` for anything else."""
    path = F.lower(F.regexp_extract(url, r"^([^?]*)", 1))
    ext = F.regexp_extract(path, r"[^/](\.[a-z0-9]+)$", 1)
    return F.when(ext.isin(FILE_EXTENSIONS), ext).otherwise(F.lit(".html"))


def is_file_url(url: Column) -> Column:
    return ~(url.startswith("/en/") | url.startswith("/ar/"))
