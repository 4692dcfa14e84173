"""Operator 2: secret scans over a trigram inverted index, in DataFrame functions only.

From each rule's pattern a Boolean trigram query is derived: an OR of ANDs of
trigrams that any match must contain (lower case).  The index holds, for every
trigram that some query asks for, the ids of the documents that contain it;
intersecting its postings gives each rule's candidates, and the pattern runs
only on those.  Rules without mandatory trigrams scan every document.

Spans are code points, end exclusive, leftmost and non-overlapping per kind;
matches whose secret part is too short are dropped after matching.

Defined results: null text counts as empty (no spans); rows with a null id are
verified by every rule; rows that repeat an id are each verified if any of
them is a candidate, and each gives a row; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import text_or_empty, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern (in the common syntax of Java, Python and RE2), secret group, its least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# The rules, in the order in which kinds are listed.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=1, least=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]+", least=24, base=True),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", least=24),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+", least=20),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

# A query is a list of clauses (OR) of trigram sets (AND); ANY holds for every text.
ANY = [frozenset()]
_MOST = 64  # strings or clauses that are followed; beyond it a weaker query is used

#: Postings for which the candidates get one file: few rows in as many files as the shuffle has partitions cost a
#: storage call or, on a local file system, three started processes a file.
POSTINGS_PER_FILE = 131_072


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _either(clauses) -> list[frozenset[str]]:
    """OR, without clauses that another one implies."""
    out: list[frozenset[str]] = []
    for c in sorted(set(clauses), key=lambda c: (len(c), sorted(c))):
        if not any(o <= c for o in out):
            out.append(c)
    return out


def _both(a, b):
    if len(a) * len(b) > _MOST:
        return min(a, b, key=len)
    return _either(x | y for x in a for y in b)


def _strings(item) -> set[str] | None:
    """The few strings a pattern item stands for, in lower case; None if they are many."""
    op, arg = str(item[0]), item[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        out: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                out.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < 8:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op == "SUBPATTERN":
        return _sequence(arg[-1])[0]
    if op == "BRANCH":
        parts = [_sequence(p)[0] for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] == 1:
        inner = _sequence(arg[2])[0]
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _query(item):
    """What any match of an item of many strings must contain."""
    op, arg = str(item[0]), item[1]
    if op == "SUBPATTERN":
        return _sequence(arg[-1])[1]
    if op == "BRANCH":
        return _either(c for p in arg[1] for c in _sequence(p)[1])
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] > 0:
        return _sequence(arg[2])[1]
    return ANY


def _sequence(items) -> tuple[set[str] | None, list[frozenset[str]]]:
    """(strings or None, query) of a sequence of pattern items."""
    run, whole, query = {""}, True, ANY
    asked = lambda strings: _either(map(_grams, strings))
    for item in items:
        own = _strings(item)
        if own is not None and len(run) * len(own) <= _MOST:
            run = {a + b for a in run for b in own}
            continue
        query, whole = _both(query, asked(run)), False
        if own is None:
            query, run = _both(query, _query(item)), {""}
        else:
            run = own
    return (run if whole else None), _both(query, asked(run))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """OR of ANDs of trigrams (lower case) that hold for every text with a match; [frozenset()] if none are mandatory."""
    return _sequence(re._parser.parse(pattern))[1]


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (gram, doc_id) of the given trigrams over the lower-cased texts, written, sorted by trigram in each file."""
    grams = F.array(*map(F.lit, trigrams)) if trigrams else F.array().cast("array<string>")
    # bound by a lambda, the lower-cased text is made once; as a column it would be made again for every trigram
    held = F.flatten(F.transform(F.array(F.lower("text")), lambda low: F.filter(grams, lambda g: low.contains(g))))
    postings = docs.filter("doc_id IS NOT NULL").select(F.explode(held).alias("gram"), "doc_id")
    return written(postings.sortWithinPartitions("gram", "doc_id"), "trigram-index")


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """doc_id, kinds: the rules whose query the postings satisfy."""
    spark = index.sparkSession
    asked = [(kind, n, len(clause), g) for kind, q in queries.items() for n, clause in enumerate(q) for g in clause]
    # a row for each trigram of each clause: fixed by the rules, and without Python workers that rows of Python need
    rows = F.array(*(F.struct(*map(F.lit, row)) for row in asked)).cast(
        "array<struct<kind:string,clause:int,need:int,gram:string>>")
    terms = F.broadcast(spark.range(0, 1, 1, 1).select(F.inline(rows)))
    met = (index.join(terms, "gram").groupBy("doc_id", "kind", "clause", "need")
           .agg(F.count_distinct("gram").alias("n")).filter("n = need"))
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule) -> Column:
    """array<(start, end)> of a rule's matches in a text.

    The pattern also captures the gap before each match, so that lengths add
    up to positions; its other branch ends the text, so every scan is linear.
    """
    pattern = F.lit(rf"(?s)(.*?)(?:({rule.pattern})|\z)")
    part = lambda group: F.regexp_extract_all(text, pattern, F.lit(group))
    pieces = F.arrays_zip(
        F.transform(part(1), F.length).alias("gap"), F.transform(part(2), F.length).alias("long"),
        F.transform(part(2 + rule.group), F.length).alias("secret"))
    none = F.array().cast("array<struct<start:int,end:int,secret:int>>")
    walked = F.aggregate(
        pieces, F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda s, p: F.struct(
            (s["at"] + p["gap"] + p["long"]).alias("at"),
            F.when(p["long"] > 0, F.concat(s["found"], F.array(F.struct(
                (s["at"] + p["gap"]).alias("start"), (s["at"] + p["gap"] + p["long"]).alias("end"),
                p["secret"].alias("secret"))))).otherwise(s["found"]).alias("found")))["found"]
    return F.filter(walked, lambda x: x["secret"] >= rule.least)


def _own_spans(n: int, rule: Rule, selective: bool) -> Column:
    """array<(start, kind, end, name)> of the n-th rule: on its candidates, or else on every text."""
    text = F.col("text")
    if selective:
        due = F.array_contains("kinds", rule.kind) | F.col("doc_id").isNull()
    elif rule.pattern.endswith("]+") and not rule.group:  # one quick look for a match that is long enough
        due = text.rlike(f"{rule.pattern[:-1]}{{{rule.least},}}")
    else:
        due = F.lit(True)
    own = F.transform(spans(text, rule), lambda x: F.struct(
        x["start"].alias("start"), F.lit(n).alias("kind"), x["end"].alias("end"), F.lit(rule.kind).alias("name")))
    return F.coalesce(F.when(due, own), F.array().cast("array<struct<start:int,kind:int,end:int,name:string>>"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, spans: array<(start, kind, end, name)> of all rules, sorted by start, then kind as listed."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    selective = {k: q for k, q in queries.items() if frozenset() not in q}
    index = trigram_index(rows, sorted({g for q in selective.values() for c in q for g in c}))
    files = max(1, -(-index.count() // POSTINGS_PER_FILE))
    found = written(candidates(index, selective).repartition(files), "secret-candidates")
    both = rows.join(found, "doc_id", "left")
    each = [_own_spans(n, rule, rule.kind in selective) for n, rule in enumerate(rules)]
    return both.select("doc_id", F.array_sort(F.concat(*each)).alias("spans"))


def as_text(spans_col: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans_col, lambda s: F.concat_ws(
        ":", s["name"], s["start"].cast("string"), s["end"].cast("string"))))
