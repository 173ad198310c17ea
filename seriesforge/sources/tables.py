"""Tables out of landed HTML.

A fragment is one row, and its tables are worked out inside that row with array
expressions: no shuffle, one pass over the text. Every table becomes
(doc_id, table_ix, columns, rows), `rows` an array of equally wide arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.functions.text import clean_markup, collapse_space, unescape_entities
from seriesforge.operators.spread import settle

NO_RESULTS = r"(?i)There are no matching results"

# Separators of cells and rows while a table's texts are decoded in one string.
CELL_MARK, ROW_MARK = "\u0001", "\u0002"


def _all(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def _span(cell: Column) -> Column:
    """Columns a cell covers; the pattern runs only where the attribute occurs."""
    opening = F.substring_index(cell, ">", 1)
    return F.when(
        opening.contains("colspan"),
        F.coalesce(F.regexp_extract(opening, r'colspan="(\d+)"', 1).try_cast("int"), F.lit(1)),
    ).otherwise(F.lit(1))


def html_tables(docs: DataFrame, html: str = "html", doc: str = "doc_id", keep: Sequence[str] = (), unescape: bool = True) -> DataFrame:
    """(doc_id, table_ix, columns, rows, has_header) of every table, in document order.

    Leading all-header rows are the header: expanded by colspan and flattened per
    column, each distinct part once, joined by " - ". Later header rows are repeats
    and dropped. Rows are padded to the widest data row; columns past the header
    are `col{i}`. A table that does not open with a header row is kept with
    has_header false and no columns.
    """
    # Marks are rare: a text without them is not rewritten.
    marked = F.col(html).contains(CELL_MARK) | F.col(html).contains(ROW_MARK)
    clear = F.when(marked, F.translate(html, CELL_MARK + ROW_MARK, "")).otherwise(F.col(html))
    bodies = (
        docs.filter(~F.col(html).rlike(NO_RESULTS))
        .select(F.col(doc).alias("doc_id"), *keep, F.posexplode(_all(clear, r"(?s)<table[^>]*>(.*?)</table>", 1)).alias("table_ix", "_body"))
    )
    grid = F.filter(
        F.transform(
            _all(F.col("_body"), r"(?s)<tr[^>]*>(.*?)</tr>", 1),
            lambda row: _all(row, r"(?s)(<(?:th|td)[^>]*>.*?</(?:th|td)>)", 1),
        ),
        lambda cells: F.size(cells) > 0,
    )
    t = settle(bodies, _grid=grid).drop("_body").filter(F.size("_grid") > 0)
    is_data = F.transform("_grid", lambda cells: F.exists(cells, lambda c: F.substring(c, 2, 2) != "th"))
    # Tags go and entities are decoded once per table, not per cell.
    joined = F.array_join(F.transform("_grid", lambda cells: F.array_join(cells, CELL_MARK)), ROW_MARK)
    t = settle(t, _is_data=is_data, _bare=F.regexp_replace(joined, "<[^>]+>", " "))
    first = F.array_position("_is_data", F.lit(True))
    heads = F.when(first > 0, first - 1).otherwise(F.size("_is_data")).cast("int")
    # Only headers are spread, so only they keep their tags.
    spans = F.transform(F.slice("_grid", F.lit(1), heads), lambda cells: F.transform(cells, _span))
    t = t.select(
        "doc_id", *keep, "table_ix", "_is_data", heads.alias("_heads"), spans.alias("_spans"),
        (unescape_entities("_bare") if unescape else F.col("_bare")).alias("_text"),
    )
    t = settle(
        t,
        _texts=F.transform(
            F.split(collapse_space(F.col("_text")), ROW_MARK), lambda r: F.transform(F.split(r, CELL_MARK), lambda x: F.trim(x))
        ),
    ).drop("_text")
    head = F.transform(
        F.slice("_texts", F.lit(1), F.col("_heads")),
        lambda cells, r: F.flatten(
            F.transform(cells, lambda text, c: F.array_repeat(text, F.get(F.get("_spans", r), c)))
        ),
    )
    data = F.filter("_texts", lambda _r, i: F.get("_is_data", i))
    t = settle(t, _head=head, _data=data).drop("_texts", "_spans", "_is_data")
    widest = lambda rows: F.array_max(F.transform(rows, lambda r: F.size(r)))
    t = settle(t, _width=widest("_data"), _depth=widest("_head"))
    names = F.transform(
        F.sequence(F.lit(0), F.coalesce("_width", "_depth", F.lit(1)) - 1),
        lambda i: F.when(i >= F.col("_depth"), F.concat(F.lit("col"), i)).otherwise(
            F.array_join(
                F.array_distinct(F.filter(F.transform("_head", lambda h: F.get(h, i)), lambda p: p.isNotNull() & (p != ""))),
                " - ",
            )
        ),
    )
    pad = lambda r: F.when(F.size(r) < F.col("_width"), F.concat(r, F.array_repeat(F.lit(""), F.col("_width") - F.size(r)))).otherwise(r)
    ok = F.col("_heads") > 0
    return t.select(
        "doc_id", *keep, F.col("table_ix"),
        F.when(ok, names).otherwise(F.array().cast("array<string>")).alias("columns"),
        F.when(ok, F.transform("_data", pad)).otherwise(F.array().cast("array<array<string>>")).alias("rows"),
        ok.alias("has_header"),
    )


def unparsed(tables: DataFrame) -> DataFrame:
    """Tables without a header row: reported, not guessed at."""
    return tables.filter(~F.col("has_header")).select("doc_id", "table_ix", F.lit("no header row found").alias("reason"))


def table_rows(tables: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per data row: (doc_id, table_ix, row_ix, columns, cells).

    Tables of one document that share a layout concatenate by (table_ix, row_ix).
    """
    return tables.select("doc_id", *keep, "table_ix", "columns", F.posexplode("rows").alias("row_ix", "cells"))


def records(rows: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows as text columns for declared names; a name the table lacks is null."""

    def named(name: str) -> Column:
        at = F.array_position("columns", F.lit(name)).cast("int")
        return F.when(at > 0, F.get("cells", at - 1)).alias(name)

    return rows.select("doc_id", *keep, "table_ix", "row_ix", *[named(c) for c in columns])


def panel_rows(rows: DataFrame, panels: Sequence[dict]) -> DataFrame:
    """Table i of a response under panel i: adds `pattern`. Tables past the last panel are left out."""
    patterns = F.array(*[F.lit(p["id_pattern"]) for p in panels])
    return rows.filter(F.col("table_ix") < len(panels)).withColumn("pattern", F.get(patterns, F.col("table_ix")))


def archive_cards(fragments: DataFrame, html: str = "html", keep: Sequence[str] = (), unescape: bool = True) -> DataFrame:
    """File-archive listing: one row per download link with its card's tag and title."""
    item = '<div class="data-list dlList-item"'
    cards = fragments.select(
        *keep,
        F.posexplode(_all(F.col(html), rf'(?s)({item}.*?)(?={item}|\z)', 1)).alias("card_ix", "_card"),
    )

    def field(pattern: str) -> Column:
        found = F.col("_card").rlike(pattern)
        return F.when(found, clean_markup(F.regexp_extract("_card", pattern, 1), unescape))

    link = r'(?s)<a href="(/-/media/[^"]+)"[^>]*class="uploaded-doc">(.*?)</a>'
    links = cards.select(
        *keep, "card_ix",
        field(r'(?s)<span class="tag">\s*(.*?)\s*</span>').alias("frequency"),
        field(r'(?s)<h2 class="title">(.*?)</h2>').alias("subcategory"),
        F.posexplode(F.arrays_zip(_all(F.col("_card"), link, 1).alias("url"), _all(F.col("_card"), link, 2).alias("label"))).alias("link_ix", "_l"),
    )
    return links.select(
        *keep, "card_ix", "link_ix",
        (unescape_entities(F.col("_l.url")) if unescape else F.col("_l.url")).alias("url"),
        clean_markup(F.col("_l.label"), unescape).alias("period_label"),
        "frequency", "subcategory",
    )
