"""Secret scans: three base rules, and Markov models of random strings and ordinary identifiers.

Two first-order character models are trained from labelled samples, one of random strings and
one of ordinary identifiers. A run of `SHORTEST` or more token characters is a secret where the
log-likelihood ratio of the two models, summed over its character pairs, exceeds `ODDS`.

Everything is DataFrame functions: matches and the pieces between them come from the regular
expression functions, positions are running lengths along both, a score is a fold over a
string's characters with the table of pair ratios as a constant. Only that table, 67 x 67
numbers, passes the driver.

Labelled samples come from the documents themselves: of the documented bound `SAMPLE` of
documents, those with the smallest hash, the values found by the base rules and digests of the
ids in three alphabets stand for random strings; long tokens of plain words outside base matches,
and neighbouring words joined as identifiers are joined, stand for ordinary ones. All documents and
whole texts are scanned.

Defined results: null text is empty and has no spans; positions are code points, ends exclusive;
repeated rows are separate rows; with nothing to train from no spans are added to the base ones;
an empty table gives an empty table; other columns are carried along, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import fresh, table

#: Fixed patterns of the base rules. The last two may name the least length at once: a shorter run
#: of theirs contains no longer match. An assignment may, so it is matched first and measured then.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SHORTEST = 16
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
#: Long tokens that may stand for ordinary ones: words of one case, capitalised or not, and short numbers, joined by separators.
SHAPED = r"^([A-Z]?[a-z]+|[A-Z]+)([_/=+-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*$"
SAMPLE = 20_000
ODDS = 12.0
SCALE = 1000  # ratios are whole thousandths, so that sums do not depend on their order

NONE = "cast(array() as array<struct<s:bigint,e:bigint,t:string>>)"
NUMBER = f"transform(regexp_extract_all(%s, '.', 0), c -> instr('{ALPHABET}', c) - 1)"


def with_matches(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """For each name an array of (start, end, matched string), leftmost and non-overlapping."""
    n = fresh(df, *[f"{k}_{part}" for k in patterns for part in ("hits", "pieces")])
    hits = {k: n[f"{k}_hits"] for k in patterns}
    pieces = {k: n[f"{k}_pieces"] for k in patterns}
    out = df.withColumns({hits[k]: F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)) for k, p in patterns.items()})
    out = out.withColumns({pieces[k]: F.when(F.size(hits[k]) > 0, F.split(F.col(text), p, -1)) for k, p in patterns.items()})
    walk = (
        "CASE WHEN size({h}) > 0 THEN aggregate(zip_with(slice({p}, 1, size({h})), {h}, (p, h) -> named_struct('p', p, 'h', h)), "
        "named_struct('at', 0L, 'out', {none}), "
        "(a, x) -> named_struct('at', a.at + length(x.p) + length(x.h), 'out', array_append(a.out, "
        "named_struct('s', a.at + length(x.p), 'e', a.at + length(x.p) + length(x.h), 't', x.h))), a -> a.out) ELSE {none} END"
    )
    made = {k: F.expr(walk.format(h=hits[k], p=pieces[k], none=NONE)) for k in patterns}
    return out.withColumns(made).drop(*hits.values(), *pieces.values())


def base_spans(df: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """Arrays of the base rules' matches under names['assign'], names['access'] and names['hex']."""
    out = with_matches(df, text, {names["assign"]: ASSIGN, names["access"]: ACCESS, names["hex"]: HEX})
    long_enough = F.filter(names["assign"], lambda m: F.length(F.regexp_extract(m["t"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return out.withColumn(names["assign"], long_enough)


def pair_counts(samples: DataFrame) -> DataFrame:
    """(random, pair, n) of labelled samples (token, random): how often each pair of characters stands in each class."""
    numbered = samples.select("random", F.expr(NUMBER % "token").alias("c"))
    pairs = numbered.filter(F.size("c") > 1).select(
        "random", F.explode(F.expr(f"transform(sequence(2, size(c)), i -> CASE WHEN c[i-2] >= 0 AND c[i-1] >= 0 THEN c[i-2] * {len(ALPHABET)} + c[i-1] END)")).alias("pair")
    )
    return pairs.filter("pair IS NOT NULL").groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))


def train(samples: DataFrame, smooth: float = 0.5, prior: float = 4.0) -> list[int]:
    """Log-likelihood ratio of each character pair, random over ordinary, in thousandths. Empty if a class is missing.

    A model is its pair counts and, with the weight of `prior` pairs, its single characters, so that a
    character seldom seen in a class speaks against the class whatever stands before it.
    """
    k = len(ALPHABET)
    counts = {True: [0] * (k * k), False: [0] * (k * k)}
    for row in pair_counts(samples).collect():  # at most 2 x 67 x 67 rows
        counts[row["random"]][row["pair"]] = row["n"]
    if not sum(counts[True]) or not sum(counts[False]):
        return []

    def chance(c: list[int]) -> list[float]:
        single = [sum(c[b::k]) + smooth for b in range(k)]
        total = sum(single)
        out = []
        for a in range(k):
            row = c[a * k : a * k + k]
            out += [(row[b] + prior * single[b] / total) / (sum(row) + prior) for b in range(k)]
        return out

    return [round(SCALE * math.log(p / q)) for p, q in zip(chance(counts[True]), chance(counts[False]))]


def ratio_of(token: str, ratios: list[int]) -> str:
    """SQL for the summed ratio of a token."""
    constant = "cast(split('" + ",".join(map(str, ratios)) + "', ',') as array<int>)"
    return (
        f"aggregate({NUMBER % token}, named_struct('b', -1, 's', 0L), (a, c) -> named_struct('b', c, 's', "
        f"a.s + CASE WHEN a.b < 0 OR c < 0 THEN 0 ELSE {constant}[a.b * {len(ALPHABET)} + c] END), a -> a.s)"
    )


def labelled_samples(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(token, random) from the sampled documents. The sample is bounded, so its join may be broadcast."""
    ids = docs.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    found = with_matches(base_spans(text, "text", {k: k for k in KINDS[:3]}), "text", {"tokens": TOKEN})
    base = F.concat("assign", "access", "hex")
    outside = F.filter("tokens", lambda t: ~F.exists(base, lambda b: (b["s"] <= t["s"]) & (t["e"] <= b["e"])))
    by_rule = found.select(F.explode(F.concat(F.transform("assign", lambda m: F.regexp_extract(m["t"], ASSIGN, 2)), F.transform(F.concat("access", "hex"), lambda m: m["t"]))).alias("token"), F.lit(True).alias("random"))
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    drawn = ids.select(
        F.explode(F.array(F.substring(digest, 1, 40), F.base64(F.unhex(digest)), F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "")))).alias("token"), F.lit(True).alias("random")
    )
    words = F.regexp_extract_all(F.col("text"), F.lit(r"\b[A-Za-z]{2,15}\b"), F.lit(0))
    # Names as people write them: words joined in the usual ways, with dates and numbers.
    three = F.slice(words, 1, 3)
    number = lambda most: F.pmod(F.hash("doc_id", F.lit(most)), F.lit(most)).cast("string")
    day = lambda k: F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(F.hash("doc_id", F.lit(k)), F.lit(12_000))).cast("string")
    joined = F.array(
        F.concat_ws("_", day(1), day(2)), F.concat_ws("-", F.lower(F.try_element_at(words, F.lit(1))), number(100), number(1000), number(10)), F.concat_ws("-", number(1000), number(999), number(10_000), number(9999)),
        F.lower(F.array_join(three, "_")), F.array_join(F.transform(three, F.initcap), ""), F.lower(F.array_join(three, "-")), F.array_join(three, "/"), F.upper(F.array_join(three, "_"))
    )
    made = text.select(F.explode(joined).alias("token"), F.lit(False).alias("random")).filter(F.length("token") > 1)
    ordinary = found.select(F.explode(F.transform(outside, lambda t: t["t"])).alias("token"), F.lit(False).alias("random")).filter(F.col("token").rlike(SHAPED))
    return by_rule.unionByName(drawn).unionByName(made).unionByName(ordinary)


def scanned(docs: DataFrame, ratios: list[int], odds: float = ODDS) -> DataFrame:
    """`docs` with one array of (start, end, matched string) for each kind: assign, access, hex, markov."""
    n = fresh(docs, "text", "tokens")
    clash = [c for c in docs.columns if c.lower() in KINDS]
    if clash:
        raise ValueError(f"rename {clash} first: these names are results")
    text = docs.withColumn(n["text"], F.coalesce(F.col("text").cast("string"), F.lit("")))
    out = base_spans(text, n["text"], {k: k for k in KINDS[:3]})
    if not ratios:
        return out.withColumn("markov", F.expr(NONE)).drop(n["text"])
    out = with_matches(out, n["text"], {n["tokens"]: TOKEN})
    fresh_ones = (
        f"filter({n['tokens']}, x -> NOT exists(concat(assign, access, hex), b -> b.s <= x.s AND x.e <= b.e) "
        f"AND {ratio_of('x.t', ratios)} > {int(odds * SCALE)})"
    )
    return out.withColumn("markov", F.expr(fresh_ones)).drop(n["text"], n["tokens"])


def listed(*kinds: str) -> Column:
    """Spans as kind:start:end by start, then kind as listed, comma-joined."""
    tagged = [
        F.expr(f"transform({k}, m -> named_struct('s', m.s, 'i', {i}, 'e', m.e, 'k', '{k}'))") for i, k in enumerate(kinds)
    ]
    ordered = F.array_sort(F.concat(*tagged))
    return F.array_join(F.transform(ordered, lambda m: F.concat_ws(":", m["k"], m["s"].cast("string"), m["e"].cast("string"))), ",")


def query(spark, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = scanned(docs, train(labelled_samples(docs)))
    return out.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(*KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
        listed(*KINDS).alias("spans"),
    )
