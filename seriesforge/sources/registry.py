"""Dataset declarations: what a landed source looks like.

A registry is data, given as a JSON file or as dictionaries; the engine ships no
list of endpoints. Only the currency codes that ids are built from are fixed here.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from seriesforge.functions.dates import DATE_KINDS
from seriesforge.operators.shape import Measure

SHAPES = ("wide", "long_by_key", "records")

# Printed currency names and the codes used in series ids.
CURRENCIES = {
    "US Dollar": "USD",
    "Euro": "EUR",
    "Pound Sterling": "GBP",
    "Canadian Dollar": "CAD",
    "Danish Krone": "DKK",
    "Norwegian Krone": "NOK",
    "Swedish Krona": "SEK",
    "Swiss Franc": "CHF",
    "Japanese Yen 100": "JPY100",
    "Saudi Riyal": "SAR",
    "Kuwaiti Dinar": "KWD",
    "UAE Dirham": "AED",
    "Australian Dollar": "AUD",
    "Bahraini Dinar": "BHD",
    "Omani Riyal": "OMR",
    "Qatari Riyal": "QAR",
    "Jordanian Dinar": "JOD",
    "Chinese Yuan": "CNY",
    "Chinese yuan": "CNY",
}
KEY_MAPS = {"currencies": CURRENCIES}


@dataclass(frozen=True)
class Dataset:
    """One declared source table."""

    key: str
    shape: str
    title_en: str = ""
    family: str = ""
    freq: str | None = None
    unit: str | None = None
    path: str = ""
    date_col: str | None = None
    date_kind: str | None = None
    key_col: str | None = None
    key_map: Mapping[str, str] = field(default_factory=dict)
    value_cols: Sequence[str] = ()
    id_pattern: str | None = None
    columns: Mapping[str, Measure] = field(default_factory=dict)
    tables: Sequence[Mapping] = ()
    variants: Sequence[Mapping] = ()
    zero_is_missing: bool = False
    expect_min_rows: int = 0

    def __post_init__(self) -> None:
        if self.shape not in SHAPES:
            raise ValueError(f"{self.key}: unknown shape {self.shape!r}")
        if self.date_kind not in DATE_KINDS:
            raise ValueError(f"{self.key}: unknown date kind {self.date_kind!r}")


def _measures(columns: Mapping | None) -> dict[str, Measure]:
    return {name: Measure(**meta) for name, meta in (columns or {}).items()}


def dataset(entry: Mapping) -> Dataset:
    e = dict(entry)
    e["columns"] = _measures(e.get("columns"))
    e["tables"] = [{**t, "columns": _measures(t.get("columns"))} for t in e.get("tables", ())]
    if isinstance(e.get("key_map"), str):
        e["key_map"] = KEY_MAPS[e["key_map"]]
    known = Dataset.__dataclass_fields__
    return Dataset(**{k: v for k, v in e.items() if k in known})


def load(entries: Iterable[Mapping] | str, only: Sequence[str] | None = None) -> list[Dataset]:
    """A registry from dictionaries or a JSON file, optionally a subset by key."""
    if isinstance(entries, str):
        with open(entries, encoding="utf-8") as fh:
            entries = json.load(fh)
    out = [dataset(e) for e in entries]
    return out if only is None else [d for d in out if d.key in set(only)]


def specs_frame(spark: SparkSession, datasets: Sequence[Dataset]) -> DataFrame:
    """Declared facts the gates join on; one row per dataset."""
    rows = [(d.key, d.shape, d.family, d.freq, d.unit, len(d.tables), int(d.expect_min_rows)) for d in datasets]
    return spark.createDataFrame(
        rows,
        "dataset string, shape string, family string, freq string, unit string, panels int, expect_min_rows int",
    )
