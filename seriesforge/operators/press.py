"""Figures and decisions out of release prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.functions import dates
from seriesforge.operators.quality import link_state
from seriesforge.operators.spread import settle
from seriesforge.operators.statements import sentences

# The words a reading looks for.
LEVEL_VERBS = ["reach", "reached", "reaching", "recorded", "registered", "amounted", "stood"]
MOVE_VERBS = ["increased", "decreased", "rose", "fell", "grew"]
DECISIONS = {"hold": ["keep", "maintain"], "hike": ["raise", "increase"], "cut": ["cut", "lower", "reduce"]}

# A reading first finds its sentence by subject words, then reads figures in it.
MONEY = r"(?i)\bUSD?\s*\$?\s*(\d[\d,]*(?:\.\d+)?)(?:\s*(billion|bn|million|mn)\b)?"
FISCAL_WINDOW = r"(?i)\bJuly\s*/\s*([a-z]+)\W+(?:of\W+)?(?:FY\W*)?(\d{4})\s*/\s*(\d{4})"
MONTH_OF_YEAR = r"(?i)\bin\s+([a-z]+)\s+(\d{4})"
#: In a sentence that states a level, a move "to" a level counts too; the first of them is read.
LEVEL = r"(?i)\b(?:" + "|".join(LEVEL_VERBS) + r")\b|\b(?:" + "|".join(MOVE_VERBS) + r")\s+to\b"
PERCENT_FIGURE = r"(?i)(\d+(?:\.\d+)?)\s*percent"

# Series of the two prose-only figures and their release categories.
RESERVES_ID = "EG.RES.NIR"
REMIT_FYTD_ID = "EG.EXT.REMIT.FYTD"
REMIT_MONTH_ID = "EG.EXT.REMIT.M"
RESERVES_CATEGORY = "International Reserves"
REMIT_CATEGORY = "Remittances"
POLICY_CATEGORY = "MPC Press Release"


def _number(raw: Column) -> Column:
    return F.regexp_replace(raw, ",", "").try_cast("double")


def _when_all(period: Column, value: Column) -> Column:
    return F.when(period.isNotNull() & value.isNotNull(), F.struct(period.alias("period"), value.alias("value")))


def _any_word(words: list[str]) -> str:
    return r"(?i)\b(" + "|".join(words) + r")\b"


def _first_sentence(said: Column, *wanted: str) -> Column:
    """The first of an array of sentences in which every pattern is found, null if there is none."""

    def has(s: Column) -> Column:
        hit = F.lit(True)
        for p in wanted:
            hit = hit & s.rlike(p)
        return hit

    return F.get(F.filter(said, has), F.lit(0))


def _behind(sentence: Column, pattern: str) -> Column:
    """What follows the first match of a pattern."""
    found = F.regexp_extract(sentence, pattern, 0)
    return F.substring(sentence, F.regexp_instr(sentence, F.lit(pattern)) + F.length(found), F.length(sentence))


def _millions(text: Column, scaled: bool) -> Column:
    """The first dollar amount in million; amounts without a scale are million unless a scale is asked for."""
    scale = F.lower(F.regexp_extract(text, MONEY, 2))
    amount = _number(F.regexp_extract(text, MONEY, 1))
    bare = F.when(scale == "", amount) if not scaled else F.lit(None).cast("double")
    return F.when(scale.isin("billion", "bn"), amount * 1000).when(scale.isin("million", "mn"), amount).otherwise(bare)


def _before(sentence: Column, pattern: str) -> Column:
    """What stands before the first match of a pattern."""
    return F.substring(sentence, F.lit(1), F.regexp_instr(sentence, F.lit(pattern)) - 1)


def reserves_sentence(said: Column) -> Column:
    return _first_sentence(said, r"(?i)\breserves?\b", _any_word(LEVEL_VERBS), MONEY)


def to_date_sentence(said: Column) -> Column:
    return _first_sentence(said, FISCAL_WINDOW, MONEY)


def month_sentence(said: Column) -> Column:
    return _first_sentence(said, r"(?i)\bremittances\b", _any_word(MOVE_VERBS), MONTH_OF_YEAR, MONEY)


def reserves_figure(sentence: Column) -> Column:
    return _millions(_behind(sentence, LEVEL), scaled=False)


def to_date_figure(sentence: Column) -> Column:
    """The amount stands right before "during" and the window, or else behind the window."""
    window = F.regexp_extract(sentence, FISCAL_WINDOW, 0)
    period = dates.fiscal_window_end(
        F.regexp_extract(window, FISCAL_WINDOW, 1),
        F.regexp_extract(window, FISCAL_WINDOW, 2).try_cast("int"),
        F.regexp_extract(window, FISCAL_WINDOW, 3).try_cast("int"),
    )
    last = F.regexp_extract(_before(sentence, FISCAL_WINDOW), MONEY + r"\s+during(?:\s+the\s+period)?\s*$", 0)
    return _when_all(period, F.coalesce(_millions(last, scaled=True), _millions(_behind(sentence, FISCAL_WINDOW), scaled=True)))


def month_figure(sentence: Column) -> Column:
    """The amount stands right before the month, or else behind it, or else is the last one before it."""
    month = F.regexp_extract(sentence, MONTH_OF_YEAR, 0)
    period = dates.safe_date(
        F.regexp_extract(month, MONTH_OF_YEAR, 2).try_cast("int"), dates.month_from_name(F.regexp_extract(month, MONTH_OF_YEAR, 1)), F.lit(1)
    )
    head = _before(sentence, MONTH_OF_YEAR)
    beside = F.regexp_extract(head, MONEY + r"\s*$", 0)
    last = F.element_at(F.regexp_extract_all(head, F.lit(MONEY), F.lit(0)), -1)
    return _when_all(period, F.coalesce(_millions(beside, scaled=True), _millions(_behind(sentence, MONTH_OF_YEAR), scaled=True), _millions(last, scaled=True)))


def reserves(text: Column) -> Column:
    """USD million, null where the release states no level."""
    return reserves_figure(reserves_sentence(sentences(text, 0)))


def remittances_to_date(text: Column) -> Column:
    """struct(period, value): fiscal-year-to-date USD million dated to the window end."""
    return to_date_figure(to_date_sentence(sentences(text, 0)))


def remittances_month(text: Column) -> Column:
    """struct(period, value): one month's USD million dated to its first day."""
    return month_figure(month_sentence(sentences(text, 0)))


def decision(text: Column) -> Column:
    """hold, hike or cut, by the first known verb after "decided to"."""
    named = F.create_map(*[F.lit(x) for name, verbs in DECISIONS.items() for verb in verbs for x in (verb, name)])
    verbs = F.transform(F.regexp_extract_all(text, F.lit(r"(?i)\bdecided to\s+([a-z]+)"), F.lit(1)), lambda w: named[F.lower(w)])
    return F.get(F.filter(verbs, lambda x: x.isNotNull()), F.lit(0))


def corridor_sentence(said: Column) -> Column:
    return _first_sentence(said, r"(?i)overnight deposit rate", r"(?i)lending rate", r"(?i)main operation", PERCENT_FIGURE)


def discount_sentence(said: Column) -> Column:
    return _first_sentence(said, r"(?i)discount rate.*\d\s*percent")


def policy_figures(text: Column, corridor: Column, discount: Column) -> Column:
    figures = F.regexp_extract_all(_behind(corridor, r"(?i)main operation"), F.lit(PERCENT_FIGURE), F.lit(1))
    moved = F.regexp_extract_all(text, F.lit(r"(?i)\bby\s+(\d[\d,]*)\s+basis points"), F.lit(1))
    return F.struct(
        *[_number(F.get(figures, F.lit(k))).alias(name) for k, name in enumerate(("deposit_rate", "lending_rate", "main_operation_rate"))],
        _number(F.regexp_extract(_behind(discount, r"(?i)discount rate"), PERCENT_FIGURE, 1)).alias("discount_rate"),
        F.regexp_replace(F.get(moved, F.lit(0)), ",", "").try_cast("int").alias("basis_points"),
        decision(text).alias("decision"),
    )


def policy(text: Column) -> Column:
    """One extractor for every statement, whatever file it came from."""
    said = sentences(text, 0)
    return policy_figures(text, corridor_sentence(said), discount_sentence(said))


def route_releases(releases: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(observations, statements, misses, dead) from releases in one pass each.

    `releases` has url, date, title, categories (array of strings) and text.
    Observations carry `ord` so that `keep_first` can follow.
    """
    state = link_state(F.col("text"))
    live = releases.filter(state == "live")
    dead = releases.filter(state == "dead").select("date", "title", "url")

    def has(name: str) -> Column:
        return F.array_contains("categories", name)

    # Sentences are cut once a row, then those that a reading is about are found, then the figures.
    wanted = has(RESERVES_CATEGORY) | has(REMIT_CATEGORY)
    cut = settle(live.select("url", "date", "categories", "text"), _said=F.when(wanted, sentences(F.col("text"), 0)))
    remit = F.when(has(REMIT_CATEGORY), F.col("_said"))
    cut = settle(cut, _level=reserves_sentence(F.when(has(RESERVES_CATEGORY), F.col("_said"))), _window=to_date_sentence(remit), _moved=month_sentence(remit))
    found = settle(cut.drop("_said"), _nir=reserves_figure(F.col("_level")), _fytd=to_date_figure(F.col("_window")), _month=month_figure(F.col("_moved")))
    point = lambda sid, p, v: F.struct(F.lit(sid).alias("series_id"), p.alias("period"), v.alias("value"))
    obs = (
        found.withColumn(
            "_o",
            F.explode(
                F.array(
                    point(RESERVES_ID, F.col("date"), F.col("_nir")),
                    point(REMIT_FYTD_ID, F.col("_fytd.period"), F.col("_fytd.value")),
                    point(REMIT_MONTH_ID, F.col("_month.period"), F.col("_month.value")),
                )
            ),
        )
        .filter(F.col("_o.value").isNotNull())
        .select("_o.*", F.struct(-F.unix_date("date"), "url").alias("ord"))
    )
    missed = F.array_compact(
        F.array(
            F.when(has(RESERVES_CATEGORY) & F.col("_nir").isNull(), F.lit("NIR")),
            F.when(has(REMIT_CATEGORY) & F.col("_fytd").isNull() & F.col("_month").isNull(), F.lit("remittances")),
        )
    )
    misses = found.select(F.explode(missed).alias("kind"), "url", F.col("text").alias("excerpt"))
    decided = settle(live.filter(has(POLICY_CATEGORY)).select("date", "title", "url", "text"), _said=sentences(F.col("text"), 0))
    decided = settle(decided, _corridor=corridor_sentence(F.col("_said")), _discount=discount_sentence(F.col("_said")))
    told = settle(decided.drop("_said"), _p=policy_figures(F.col("text"), F.col("_corridor"), F.col("_discount")))
    statements = told.select("date", "title", "url", "text", "_p.*")
    return obs, statements, misses, dead
