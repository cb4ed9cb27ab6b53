"""Secret scans through a trigram inverted index, in DataFrame functions only.

Each rule's pattern is turned into a Boolean query over trigrams that every
match must hold.  Postings (trigram, doc_id) are written for the trigrams that
some rule asks for, intersected per document, and only documents that satisfy
a rule's query are verified with its pattern.  A rule without a mandatory
trigram (a bare character class) scans every text.

Verification keeps the leftmost non-overlapping matches of a rule, and drops
those whose chosen group is too short without trying again inside them.
Positions are code points, end exclusive.

A null or empty text has no spans.  Rows that repeat a doc_id are each
scanned; a null doc_id is scanned like any other.  Other columns are not
looked at.  Texts are scanned whole: n matches in one text take time by
n * sqrt(n) at most.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Strings a pattern's piece may stand for before its trigrams are taken.
MOST_STRINGS = 32


@dataclass(frozen=True)
class Rule:
    """``group`` is the group (0: the match) that needs ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)


# --- from a pattern to a Boolean query: True, a trigram, ("and"|"or", parts) ---

def _join(kind: str, parts: list) -> object:
    """``and`` / ``or`` of queries; True asks for nothing."""
    if kind == "or" and any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _needs(strings: set[str]) -> object:
    """What a text must hold to hold one of the strings; a string that asks for more than another adds nothing."""
    sets = {s: {s[i:i + 3] for i in range(len(s) - 2)} for s in sorted(strings)}
    least = [s for s in sets if not any(sets[o] < sets[s] or (sets[o] == sets[s] and o < s) for o in sets)]
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in least])


def _strings(op: object, arg: object) -> set[str] | None:
    """All lower-cased strings that a single-character item stands for, if few."""
    if op is rc.LITERAL:
        return {chr(arg).lower()}
    if op is rc.IN and all(k in (rc.LITERAL, rc.RANGE) for k, _ in arg):
        made = {chr(c).lower() for k, v in arg for c in ([v] if k is rc.LITERAL else range(v[0], min(v[1], v[0] + MOST_STRINGS) + 1))}
        return made if len(made) <= 8 else None
    return None


def _query(items) -> tuple[set[str] | None, object]:
    """(all strings the sequence stands for, if few; its query)."""
    found, run, exact = [], {""}, True

    def close() -> None:
        nonlocal run, exact
        found.append(_needs(run))
        run, exact = {""}, False

    for op, arg in items:
        strings, query = _strings(op, arg), True
        if op is rc.SUBPATTERN:
            strings, query = _query(arg[3])
        elif op is rc.BRANCH:
            parts = [_query(x) for x in arg[1]]
            strings = set().union(*(s for s, _ in parts)) if all(s is not None for s, _ in parts) else None
            query = True if strings is not None else _join("or", [q if s is None else _join("and", [q, _needs(s)]) for s, q in parts])
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, body = arg
            inner, q = _query(body)
            if inner is not None and (low, high) == (0, 1):
                strings = inner | {""}
            elif inner is not None and low == high and len(inner) ** low <= MOST_STRINGS:
                strings = reduce(lambda a, b: {x + y for x in a for y in b}, [inner] * low, {""})
            else:
                query = q if low and inner is None else _needs(inner) if low and inner else True
        elif op is rc.AT:
            continue
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            found.append(query)
        else:
            close()
            found.append(query if strings is None else _join("and", [query, _needs(strings)]))
    if exact:
        return run, _join("and", found)
    found.append(_needs(run))
    return None, _join("and", found)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query (over lower-cased text) that each match satisfies."""
    strings, query = _query(rp.parse(pattern))
    return query if strings is None else _join("and", [query, _needs(strings)])


def trigrams_of(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def _holds(query: object, number: dict[str, int], have: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(have, number[query])
    parts = [_holds(q, number, have) for q in query[1]]
    return reduce((lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b), parts)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram number, doc_id) for each listed trigram that a text holds."""
    held = F.array_compact(F.array(*[F.when(F.col("t").contains(t), F.lit(i)) for i, t in enumerate(trigrams)]))
    return docs.select("doc_id", F.lower("text").alias("t")).select("doc_id", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame, dict[str, object]]:
    """(doc_id, one flag per indexed rule), and the rules' queries."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted(set().union(*map(trigrams_of, queries.values())))
    number = {t: i for i, t in enumerate(trigrams)}
    lists = C.stored(postings(docs, trigrams), "postings").groupBy("doc_id").agg(F.collect_set("trigram").alias("have"))
    flags = {k: _holds(q, number, F.col("have")) for k, q in queries.items() if q is not True}
    found = lists.select("doc_id", *[f.alias(f"may_{k}") for k, f in flags.items()])
    return found.where(reduce(lambda a, b: a | b, [F.col(f"may_{k}") for k in flags])), queries


def _spans(rule: Rule, order: int) -> Column:
    """Array of (start, order, end) of the rule's kept matches."""
    # each find starts where the last ended; group 1 is what lies between, 2 the match
    pattern = F.lit(rf"\G(?s:(.*?))({rule.pattern})")
    part = lambda g: F.regexp_extract_all("text", pattern, F.lit(g))
    sizes = F.arrays_zip(F.transform(part(1), F.char_length).alias("gap"), F.transform(part(2), F.char_length).alias("n"),
                         F.transform(part(2 + rule.group), F.char_length).alias("k"))
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")

    def step(at: Column, x: Column) -> Column:
        start = at["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), (start + x["n"]).alias("end"))
        return F.struct((start + x["n"]).alias("at"), F.when(x["k"] >= rule.least, F.concat(at["out"], F.array(span))).otherwise(at["out"]).alias("out"))

    # an array that grows by each match is copied each time, so n matches are run through in pieces of about sqrt(n)
    def piecewise(z: Column) -> Column:
        w = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(z).cast("double"))).cast("int"))
        cut = F.transform(F.sequence(F.lit(0), w - 1), lambda i: F.slice(z, i * w + 1, w))
        return _bound(cut, lambda pieces: F.flatten(F.transform(F.arrays_zip(pieces.alias("piece"), begins(pieces).alias("at")), lambda p: F.aggregate(
            p["piece"], F.struct(p["at"].alias("at"), none.alias("out")), step, lambda at: at["out"]))))

    def begins(pieces: Column) -> Column:
        sums = F.transform(pieces, lambda piece: F.aggregate(piece, F.lit(0), lambda n, x: n + x["gap"] + x["n"]))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(sums, zero, lambda at, n: F.struct((at["at"] + n).alias("at"), F.concat(at["out"], F.array(at["at"])).alias("out")), lambda at: at["out"])

    return _bound(sizes, piecewise)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def secret_spans(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """doc_id, text and ``found``: an array of (start, order of the rule, end), sorted."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found, queries = candidates(docs, rules)
    found = C.stored(found, "secret-candidates")
    may = C.small(found, 64).withColumnRenamed("doc_id", "candidate")
    docs = docs.join(may, F.col("doc_id").eqNullSafe(F.col("candidate")), "left")
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")
    parts = []
    for i, rule in enumerate(rules):
        if queries[rule.kind] is True:  # no mandatory trigram: the whole text is scanned
            asked = F.col("text").rlike(f"(?:{rule.pattern[:-1]}{{{rule.least},}})" if rule.group == 0 and rule.pattern[-1] == "+" else rule.pattern)
        else:
            asked = F.coalesce(F.col(f"may_{rule.kind}"), F.lit(False))
        parts.append(F.when(asked, _spans(rule, i)).otherwise(none))
    return docs.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("found"))


def spelled(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"], s["end"])), ",")


def op6_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of all ``documents``, with a digest of the base rules' spans."""
    rules = BASE_RULES + MORE_RULES
    f = secret_spans(spark, C.table(spark, sf_dir, "documents"), rules)
    base = F.filter("found", lambda s: s["order"] < len(BASE_RULES))
    count = lambda i: F.size(F.filter("found", lambda s: s["order"] == i)).cast("long")
    return f.select("doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)],
                    F.sha2(spelled(base, rules), 256).alias("base_sha256"), spelled(F.col("found"), rules).alias("spans"))
