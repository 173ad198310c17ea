"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to one string. Successive turn
prefixes are rendered and consecutive outputs compared: what the longer output adds is the
turn's span. If the longer output does not begin with the shorter one, the template has
rewritten history, which is reported. Inside a span the text is found by rendering the turn
twice more with two texts that differ in their first and last character: what both outputs
share before and behind is the turn's frame. Nothing is asked of the template but its output.

The turns of a conversation are read in order from a sorted partition, all of them. Without `context`
every prefix is rendered from the start: exact for any template, in time that grows with the square of
the conversation. A caller who knows how far back a template looks passes `context`: then state is the
last `context` turns and a few running digests, so a conversation of any length fits, and a turn is
rendered behind at least half of them. No turn is left out either way.

Defined results: a null role or text is empty; a null turn sorts first; turns with equal number
sort by role, then text; repeated rows are turns of their own; a null conv_id is one
conversation; an empty table gives no rows beyond the ones asked for; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import in_batches, table

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
ROLES = {v: k for k, v in NAMES.items()}
HEAD, AFTER_ROLE, END = "### ", ": ", " </turn>\n"
FRAME = re.compile(r"### ((?:[^\\:]|\\.)*): (.*) </turn>\n\Z", re.S)


def escape(text: str) -> str:
    """Control strings cannot occur in the result: no #, and no </ that ends a turn, stands unmarked."""
    if "\\" in text or "#" in text or "</turn>" in text:
        return text.replace("\\", "\\\\").replace("#", "\\#").replace("</turn>", "<\\/turn>")
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def shown_role(role: str) -> str:
    return NAMES.get(role) or "=" + escape(role).replace(":", "\\:")


def marked_turns(turns: list[Turn]) -> str:
    """The template of the registered query: `### Role: text </turn>` lines."""
    return "".join(f"{HEAD}{shown_role(r)}{AFTER_ROLE}{escape(t)}{END}" for r, t in turns)


def parse_turn(span: str) -> Turn:
    """One turn back from its span of the output."""
    m = FRAME.match(span)
    if not m:
        raise ValueError("not one turn")
    name = m[1]
    return (ROLES[name] if name in ROLES else unescape(name[1:])), unescape(m[2])


def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


class Incremental:
    """Feeds turns one by one; each gives (span added, start and end of its text in the span, rewritten)."""

    def __init__(self, template: Template, context: int | None = None):
        self.template, self.context = template, context
        self.turns: list[Turn] = []
        self.shown = template([])

    def push(self, role: str, text: str) -> tuple[str, int, int, bool]:
        if self.context is not None and len(self.turns) >= self.context:
            self.turns = self.turns[self.context // 2 :]
            self.shown = self.template(self.turns)
        before, kept = self.shown, self.turns
        whole = self.template([*kept, (role, text)])
        at = common_prefix(before, whole)
        rewritten = at < len(before)
        span = whole[at:]
        # Two texts that share neither their first nor their last character leave only the frame in common.
        one, two = self.template([*kept, (role, "a")])[at:], self.template([*kept, (role, "b")])[at:]
        head = common_prefix(one, two)
        tail = common_prefix(one[head:][::-1], two[head:][::-1])
        self.turns, self.shown = [*kept, (role, text)], whole
        return span, head, len(span) - tail, rewritten


def digests(template: Template, parse: Callable[[str], Turn], context: int | None, learns: str = "assistant"):
    """A function for mapInPandas over rows sorted by conversation and turn."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None

        def close(c):
            return (c["id"], c["n"], c["turns"].hexdigest(), c["loss_n"], c["loss"].hexdigest(), c["chars"], c["rewritten"])

        def open_(key):
            inc = Incremental(template, context)
            return {"id": key, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_n": 0, "chars": len(inc.shown), "rewritten": False, "inc": inc}

        for batch in batches:
            done = []
            keys = [None if pd.isna(k) else int(k) for k in batch["conv_id"]]
            for key, role, text in zip(keys, batch["role"], batch["text"]):
                if now is None or now["id"] != key:
                    if now is not None:
                        done.append(close(now))
                    now = open_(key)
                span, start, end, rewritten = now["inc"].push(role, text)
                back_role, back_text = parse(span)
                now["n"] += 1
                now["chars"] += len(span)
                now["rewritten"] |= rewritten
                now["turns"].update(f"{back_role}\n{back_text}\n".encode())
                if back_role == learns:
                    masked = unescape(span[start:end])
                    now["loss"].update(masked.encode())
                    now["loss_n"] += len(masked)
            yield pd.DataFrame(done, columns=COLUMNS).astype({"conv_id": "Int64"})
        if now is not None:
            yield pd.DataFrame([close(now)], columns=COLUMNS).astype({"conv_id": "Int64"})

    return run


COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"]
SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites_history boolean"


def formatted(conversations: DataFrame, template: Template = marked_turns, parse=parse_turn, context: int | None = None) -> DataFrame:
    """One row per conversation with what is read back from its rendered form."""
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return in_batches(ordered).mapInPandas(digests(template, parse, context), SCHEMA)


# `marked_turns` writes a turn without looking at others, so any window gives what whole prefixes give.
MARKED_TURNS_CONTEXT = 512
PLANTED = r"\### Assistant: </turn> ok"


def query(spark, sf: str) -> DataFrame:
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], "conv_id long, turn long, role string, text string")
    return formatted(given.unionByName(extra), context=MARKED_TURNS_CONTEXT).drop("rewrites_history")


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), shown AS (
  SELECT *, length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>')) + length(role)
    + CASE WHEN role IN ('system', 'user', 'assistant') THEN 0 ELSE 1 + length(regexp_replace(role, '[^\\#:]', '', 'g')) + (length(replace(role, '</turn>', '</turn>.')) - length(role)) END
    + 4 + 2 + 9 AS chars
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""
