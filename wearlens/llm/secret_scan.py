"""Secret scans through a trigram inverted index, with built-in functions alone.

From each rule's regex a Boolean query over lower-case trigrams is derived: whatever the regex
matches contains all trigrams of at least one of the query's alternatives. The index lists, for each
trigram the queries name, the documents that contain it, as bitmaps of 64 neighbouring ids. A query
intersects the bitmaps of an alternative's trigrams and unites the alternatives; only the documents
left are searched with the regex. A rule without mandatory trigrams searches every document.

Matches are leftmost and do not overlap within a rule; a match whose value (a group of the regex)
is too short is dropped after it has consumed its text. Positions count code points, end exclusive.

Defined results. Null text is empty. A row without doc_id is not in the index and is searched with
every rule; rows that repeat a doc_id share their bit, so each is searched if one is a candidate.
An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import re._constants as K
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from wearlens.llm.store import BLOCK, BLOCK_OF, keep, let, own, set_aside, with_flags

MARK = "__secret_"  # begins the columns that scan adds
MOST_STRINGS = 64  # a literal part of a regex with more spellings than this is not expanded


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # read alike by Python's and Java's regex
    least: int = 0  # code points the value must have
    group: int = 0  # the group that is the value
    guard: str = ""  # where no trigram is mandatory: a cheaper regex that every kept match contains


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24, guard="[0-9a-f]{24}"),
)
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)


def _literals(items) -> tuple[set[str] | None, list[set[str]]]:
    """All strings a parsed regex matches, lower-cased, if they are few; and sets of strings of which
    each match contains one."""
    clauses: list[set[str]] = []
    now: set[str] = {""}
    exact = True

    def flush():
        nonlocal now
        if all(len(s) >= 3 for s in now):
            clauses.append(now)
        now = {""}

    for op, arg in items:
        strings, more, ends = None, [], False
        if op is K.LITERAL:
            strings = {chr(arg).lower()}
        elif op is K.AT:
            strings = {""}
        elif op is K.IN and all(o is K.LITERAL for o, _ in arg) and len(arg) <= 8:
            strings = {chr(c).lower() for _, c in arg}
        elif op is K.SUBPATTERN:
            strings, more = _literals(arg[3])
        elif op is K.BRANCH:
            parts = [_literals(p) for p in arg[1]]
            if all(p[0] is not None for p in parts):
                strings = set().union(*[p[0] for p in parts])
            elif all(p[1] for p in parts):
                more = [set().union(*[p[1][0] for p in parts])]
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT):
            low, high, inner = arg
            strings, more = _literals(inner)
            if low == 0:
                more = []
                strings = strings | {""} if strings is not None and high == 1 else None
            elif not low == high == 1:
                ends = True  # at least once, then unknown
        if strings is not None and len(now) * len(strings) <= MOST_STRINGS:
            now = {a + b for a, b in product(now, strings)}
            if ends:
                exact = False
                flush()
        else:
            exact = False
            flush()
            clauses += more
    whole = now if exact else None
    flush()
    return whole, clauses


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each a set of trigrams that all occur; empty if no trigram is mandatory."""
    _, clauses = _literals(parser.parse(pattern))
    query: set[frozenset[str]] = {frozenset()}
    for clause in clauses:
        grams = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in clause}
        wider = {a | b for a in query for b in grams}
        if len(wider) <= MOST_STRINGS:
            query = {a for a in wider if not any(b < a for b in wider)}
    return sorted((q for q in query if q), key=sorted) if frozenset() not in query else []


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: trigram, __block (of 64 ids), bits of the documents that contain it."""
    present = let(F.lower("text"), lambda t: F.filter(F.array(*map(F.lit, trigrams)), lambda g: F.contains(t, g)))
    bit = F.expr(f"shiftleft(1L, cast(pmod(doc_id, {BLOCK}) as int))")
    rows = own(docs, "doc_id", "text").filter("doc_id is not null")
    rows = rows.select(F.expr(BLOCK_OF).alias("__block"), bit.alias("bit"), F.explode(present).alias("trigram"))
    return rows.groupBy("trigram", "__block").agg(F.bit_or("bit").alias("bits"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Per block a bitmap ``__rule`` of the documents that satisfy each rule's query."""
    terms = [(rule, i, g, len(alt)) for rule, alts in queries.items() for i, alt in enumerate(alts) for g in sorted(alt)]
    asked = index.sparkSession.createDataFrame(terms, "rule string, alternative int, trigram string, n int")
    met = (
        index.join(F.broadcast(asked), "trigram")  # as many rows as the rules have trigrams
        .groupBy("__block", "rule", "alternative", "n")
        .agg(F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("found"))
        .filter("found = n and bits != 0")
    )
    none = F.lit(0).cast("long")
    return met.groupBy("__block").agg(*[F.bit_or(F.when(F.col("rule") == r, F.col("bits")).otherwise(none)).alias(f"__{MARK}{r}") for r in queries])


_SPANS = "array<struct<start:int,end:int>>"


def find(text: Column, rule: Rule) -> Column:
    """Spans of the rule's matches in ``text``.

    What stands between matches (split) and the matches give the positions by adding up lengths.
    """
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("value"),
    )
    begin = lambda s, x: s["at"] + F.length(x["between"])
    size = lambda x: F.coalesce(F.length(x["match"]), F.lit(0))
    span = lambda s, x: F.struct(begin(s, x).alias("start"), (begin(s, x) + size(x)).alias("end"))
    return F.aggregate(
        zipped,
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans")),
        lambda s, x: F.struct(
            (begin(s, x) + size(x)).alias("at"),
            F.when(F.length(x["value"]) >= rule.least, F.array_append(s["spans"], span(s, x))).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )


def scan(docs: DataFrame, rules: tuple[Rule, ...] = (*BASE, *ADDED)) -> DataFrame:
    """``docs`` with a column ``__secret_<kind>`` per rule: its spans in the text, in order; null without text."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted(set().union(*[alt for q in queries.values() for alt in q]))
    flagged = docs
    if queries:
        index = keep(build_index(docs, trigrams), "trigram-index")
        flagged = with_flags(flagged, keep(candidates(index, queries), "candidates"), *[MARK + r for r in queries])
    found = {}
    for r in rules:
        if r.kind in queries:
            wanted = F.col(MARK + r.kind) | F.col("doc_id").isNull()
        else:
            wanted = F.col("text").rlike(r.guard or r.pattern)
        found[MARK + r.kind] = F.when(wanted, find(F.col("text"), r)).otherwise(F.array().cast(_SPANS))
    return flagged.withColumns(found)


def ordered(rules) -> Column:
    """All spans of the rules by start, then by the rules' order: structs start, rank, end, kind."""
    def tag(i: int, kind: str) -> Column:
        return F.transform(MARK + kind, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    tagged = [tag(i, r.kind) for i, r in enumerate(rules)]
    return F.coalesce(F.array_sort(F.concat(*tagged)), F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))


def listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlapping spans melt into the first."""
    cut = lambda s, x: F.substring(text, s["at"] + 1, x["start"] - s["at"])
    step = lambda s, x: F.when(
        x["start"] >= s["at"],
        F.struct(x["end"].alias("at"), F.concat(s["parts"], F.array(cut(s, x), F.concat(F.lit("["), x["kind"], F.lit("]")))).alias("parts")),
    ).otherwise(F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["parts"].alias("parts")))
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        step,
        lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text))),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = (*BASE, *ADDED)) -> DataFrame:
    """``docs`` with every secret in the text replaced by its kind, and n_chars, if there is one, by the new length."""
    return set_aside(docs, lambda plain: _redact(plain, rules), "doc_id", "text", "n_chars")


def _redact(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    names = [MARK + r.kind for r in rules]
    found = scan(docs, rules).withColumn("__spans", ordered(rules)).drop(*names)
    text = F.when(F.size("__spans") > 0, redacted(F.col("text"), F.col("__spans"))).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size("__spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
