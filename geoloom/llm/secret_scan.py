"""Secret scan over a trigram inverted index, in DataFrame functions only.

The Boolean trigram query of each rule is derived from its pattern: what the
pattern must contain, as alternatives of trigrams that all have to occur. The
index holds, for each trigram a query asks for and each part of the documents,
the posting list of the ids that contain it. Lists are intersected and united
within a part; the documents found are candidates and only they are verified
with the pattern. Rules without a mandatory trigram scan every text.
"""

from __future__ import annotations

import math
import re._constants as codes
import re._parser as parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.runtime import broadcast_if_small, checkpoint

#: Documents whose posting lists are held together.
PART_DOCUMENTS = 4096
_MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A pattern (same meaning in Java and Python); group `group` of a match must have at least `least` characters."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules, in the order in which spans that start together are listed, then the added ones.
BASE_RULES = (
    Rule("assign", r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
                   r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
MORE_RULES = (
    Rule("key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("repository", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + MORE_RULES

Clause = frozenset  # of alternatives, each a frozenset of trigrams that all occur


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _clause(strings: set[str]) -> Clause | None:
    """What it means that one of the strings occurs; None if that says nothing about trigrams."""
    shortest = {s for s in strings if not any(o != s and o in s for o in strings)}
    return None if any(len(s) < 3 for s in shortest) else frozenset(map(_trigrams, shortest))


def _walk(items) -> tuple[set[str] | None, list[Clause]]:
    """The strings a parsed pattern can match (None: too many) and the clauses that hold for its matches."""
    clauses: list[Clause] = []
    strings: set[str] = {""}
    whole = True

    def flush() -> None:
        nonlocal strings, whole
        if (clause := _clause(strings)) is not None:
            clauses.append(clause)
        strings, whole = {""}, False

    for code, value in items:
        choices: set[str] | None = None
        if code is codes.LITERAL:
            choices = {chr(value).lower()}
        elif code is codes.IN:
            letters: set[str] = set()
            for kind, member in value:
                if kind is codes.LITERAL:
                    letters.add(chr(member).lower())
                elif kind is codes.RANGE and member[1] - member[0] < 8:
                    letters |= {chr(c).lower() for c in range(member[0], member[1] + 1)}
                else:
                    letters |= {""} | {chr(i) for i in range(_MOST_STRINGS)}
            choices = letters if len(letters) <= 8 else None
        elif code is codes.SUBPATTERN:
            choices, inner = _walk(value[3])
            if choices is None:
                flush()
                clauses += inner
                continue
        elif code is codes.BRANCH:
            branches = [_walk(b) for b in value[1]]
            if all(b[0] is not None for b in branches):
                choices = set().union(*(b[0] for b in branches))
            else:
                flush()
                firsts = [b[1][0] if b[1] else _clause(b[0] or {""}) for b in branches]
                if all(f is not None for f in firsts):
                    clauses.append(frozenset().union(*firsts))
                continue
        elif code is codes.MAX_REPEAT and value[1] == 1 and value[0] == 0:
            inner_strings, _ = _walk(value[2])
            choices = inner_strings | {""} if inner_strings is not None else None
        elif code is codes.MAX_REPEAT and value[0] >= 1:
            inner_strings, inner = _walk(value[2])
            if inner_strings is None:
                flush()
                clauses += inner
                continue
        if choices is None or len(strings) * len(choices) > _MOST_STRINGS:
            flush()
            if choices is not None and len(choices) <= _MOST_STRINGS:
                strings = set(choices)
        else:
            strings = {s + c for s in strings for c in choices}
    if whole:
        return strings, []
    flush()
    return None, clauses


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses over trigrams of the lower-cased text that every text with a match satisfies. Empty: the pattern has no mandatory trigram."""
    strings, clauses = _walk(parser.parse(pattern))
    if strings is not None:
        clause = _clause(strings)
        return [clause] if clause is not None else []
    return list(dict.fromkeys(clauses))


def trigram_index(rows: DataFrame, trigrams: list[str], parts: int) -> DataFrame:
    """Posting lists (part, trigram, ids) of `trigrams` over rows (id, text); a list has the documents of one part at most."""
    wanted = F.array(*map(F.lit, sorted(trigrams)))
    held = F.filter(wanted, lambda t: F.contains(F.col("folded"), t))
    postings = rows.select("id", F.lower("text").alias("folded")).select("id", F.explode(held).alias("trigram")).filter("id IS NOT NULL")
    return postings.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).groupBy("part", "trigram").agg(F.collect_set("id").alias("ids"))


def candidates(index: DataFrame, queries: dict[str, list[Clause]]) -> DataFrame:
    """Rows (id, rules): the documents whose trigrams satisfy a query, and the queries they satisfy."""
    lists = index.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def marked(ids: Column, name: str) -> Column:
        return F.transform(ids, lambda i: F.struct(i.alias("id"), F.lit(name).alias("rule")))

    def having(trigrams: frozenset[str]) -> Column:
        return reduce(F.array_intersect, [F.coalesce(F.try_element_at("lists", F.lit(t)), none) for t in sorted(trigrams)])

    found = []
    for name, clauses in queries.items():
        ids = reduce(F.array_intersect, [reduce(F.array_union, map(having, sorted(c, key=sorted))) for c in clauses])
        found.append(marked(ids, name))
    return lists.select(F.explode(F.concat(*found)).alias("hit")).groupBy("hit.id").agg(F.collect_set("hit.rule").alias("rules"))


def _spans(text: str, place: int, rule: Rule) -> Column:
    """Spans of a rule in a text: lengths of the pieces between matches and of the matches, added up."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    checked = F.regexp_extract_all(F.col(text), pattern, F.lit(rule.group)) if rule.group else matches
    steps = F.zip_with(
        F.zip_with(F.split(F.col(text), rule.pattern, -1), matches, lambda gap, m: F.struct(F.length(gap).cast("long").alias("gap"), m.alias("value"))),
        checked, lambda s, c: F.struct(s["gap"].alias("gap"), s["value"].alias("value"), (F.length(c) >= rule.least).alias("right")))
    empty = F.array().cast("array<struct<start: bigint, place: int, end: bigint, rule: string, value: string>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def step(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["gap"]
        end = begin + F.length(s["value"])
        span = F.struct(begin.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.name).alias("rule"), s["value"].alias("value"))
        return F.struct(F.coalesce(end, acc["at"]).alias("at"), F.when(s["right"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.when(F.col(text).rlike(rule.pattern), F.aggregate(steps, start, step, lambda acc: acc["out"])).otherwise(empty)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: id and `spans`, an array of (start, place, end, rule, value) by start and place of the rule, in code points, end exclusive.

    Matches of a rule are the leftmost ones that do not overlap; one whose
    checked group is too short is dropped and not tried again. A null or empty
    text has no spans. Rows with a null id are verified without the index; rows
    that share an id are candidates together. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    queries = {r.name: q for r in rules if (q := trigram_query(r.pattern))}
    if not queries:
        joined = rows.withColumn("rules", F.array().cast("array<string>"))
    else:
        parts = max(1, math.ceil(rows.count() / PART_DOCUMENTS))
        trigrams = {t for q in queries.values() for clause in q for alternative in clause for t in alternative}
        # Fixed once: it is measured for the join and then joined.
        found = checkpoint(candidates(trigram_index(rows, sorted(trigrams), parts), queries))
        joined = rows.join(broadcast_if_small(found), "id", "left")
    listed = [
        _spans("text", i, r) if r.name not in queries else
        F.when(F.col("id").isNull() | F.array_contains("rules", r.name), _spans("text", i, r))
        .otherwise(F.array().cast("array<struct<start: bigint, place: int, end: bigint, rule: string, value: string>>"))
        for i, r in enumerate(rules)]
    return joined.select(F.col("id").alias(id_col), F.array_sort(F.concat(*listed)).alias("spans"))
