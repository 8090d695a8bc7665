"""Secret scan over a trigram index: Boolean queries from the rules' regexes, then verification."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import fresh, let, stage

#: Candidate texts up to which their table is broadcast (48 bytes a row at most).
BROADCAST_ROWS = 500_000
# Delimits matches while they are located; a text's own are replaced by a character of equal length
# that no rule can match.
_MARK, _OTHER = "\ue000", "\x01"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``at_least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 0


# The three base rules.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        at_least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Kinds that only this scan knows.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE

# A Boolean query is True (no condition), a trigram, or ("and" | "or", frozenset of queries).
_LIMIT = 16


def _join(op: str, parts) -> object:
    parts = set(parts)
    if op == "and":
        parts.discard(True)
        if not parts:
            return True
    elif True in parts or not parts:
        return True
    return parts.pop() if len(parts) == 1 else (op, frozenset(parts))


def _of_strings(strings: set[str]) -> object:
    """Trigrams that a text with any of ``strings`` has."""
    return _join(
        "or",
        [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in {s.lower() for s in strings}],
    )


def _analyse(tree) -> tuple[object, set[str] | None]:
    """Condition on a matching text, and the strings the expression matches if they are few."""
    conditions, exact = [], {""}

    def flush():
        nonlocal exact
        conditions.append(_of_strings(exact))
        exact = {""}

    for op, value in tree:
        op, strings = str(op), None
        if op == "LITERAL":
            strings = {chr(value)}
        elif op == "IN" and all(str(k) == "LITERAL" for k, _ in value) and len(value) <= 4:
            strings = {chr(v) for _, v in value}
        elif op == "SUBPATTERN":
            condition, strings = _analyse(value[-1])
            if strings is None:
                conditions.append(condition)
        elif op == "BRANCH":
            sides = [_analyse(side) for side in value[1]]
            if all(s is not None for _, s in sides):
                strings = set().union(*[s for _, s in sides])
            else:
                conditions.append(_join("or", [c if s is None else _of_strings(s) for c, s in sides]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = value
            condition, several = _analyse(inner)
            if several is not None and (int(low), int(high)) == (0, 1):
                strings = several | {""}
            elif int(low) > 0:
                conditions.append(condition if several is None else _of_strings(several))
        if strings is None:
            flush()
        elif len(exact) * len(strings) > _LIMIT:
            flush()
            exact = set(strings)
        else:
            exact = {a + b for a, b in product(exact, strings)}
    if not conditions:
        return _of_strings(exact), exact
    conditions.append(_of_strings(exact))
    return _join("and", conditions), None


def trigram_query(pattern: str) -> object:
    """What a text must contain, in lower-case trigrams, to match ``pattern``; True if nothing is certain."""
    return _analyse(regex_parser.parse(pattern))[0]


def _trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(_trigrams, query[1]))


def _holds(query: object, has: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(has, query)
    sides = [_holds(q, has) for q in sorted(query[1], key=str)]
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, sides)


def build_index(docs: DataFrame, trigrams: list[str], text: str = "text") -> DataFrame:
    """Postings ``(trigram, key)`` of the trigrams that any rule asks for; key is the text's hash.

    Equal texts share a posting. A hash shared by different texts only adds a candidate.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    asked = F.array(*[F.lit(t) for t in trigrams])
    found = let(F.lower(value), lambda low: F.filter(asked, lambda t: low.contains(t)))
    rows = docs.select(F.xxhash64(value).alias("key"), F.explode(found).alias("trigram"))
    return rows.groupBy("trigram", "key").agg(F.lit(1).alias("one")).select("trigram", "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(key, kinds)``: texts whose postings satisfy the query of at least one rule that has one."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    has = index.groupBy("key").agg(F.collect_set("trigram").alias("has"))
    kinds = [F.when(_holds(q, F.col("has")), F.lit(kind)) for kind, q in queries.items() if q is not True]
    return has.select("key", F.array_compact(F.array(*kinds)).alias("kinds")).filter(F.size("kinds") > 0)


def spans(text: Column, rule: Rule) -> Column:
    """All matches of a rule, leftmost and not overlapping: array of (start, end) in code points."""
    value = F.translate(text, _MARK, _OTHER)
    marked = F.regexp_replace(value, rule.pattern, f"{_MARK}$0{_MARK}${rule.group}{_MARK}")
    lengths = F.transform(F.split(marked, _MARK), lambda part: F.length(part))

    def located(n: Column) -> Column:
        # Gap, match and group alternate; the last gap has no match behind it.
        empty = F.struct(
            F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("found")
        )

        def step(state: Column, i: Column) -> Column:
            start = state["at"] + n[i * 3]
            end = start + n[i * 3 + 1]
            one = F.array(F.struct(start.alias("start"), end.alias("end")))
            good = n[i * 3 + 2] >= rule.at_least
            found = F.when(good, F.concat(state["found"], one)).otherwise(state["found"])
            return F.struct(end.alias("at"), found.alias("found"))

        last = F.floor(F.size(n) / 3).cast("int") - 1
        return F.aggregate(F.sequence(F.lit(0), last), empty, step)["found"]

    none = F.array().cast("array<struct<start: int, end: int>>")
    return F.when(text.rlike(rule.pattern), let(lengths, located)).otherwise(none)


def _no_spans() -> Column:
    return F.array().cast("array<struct<start: int, kind: int, end: int>>")


def _of_kind(found: Column, number: int) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")),
    )


def find_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: array of (start, kind, end), by start, then rule order.

    Null and empty texts have no spans, repeated rows are scanned each. The column is called
    ``secrets``, with underscores before it if ``docs`` has such a column. ``kind`` is the rule's number.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted(set().union(*map(_trigrams, queries.values())))
    name, key, kinds = fresh(docs, "secrets"), fresh(docs, "secret_key"), fresh(docs, "secret_kinds")
    value = F.coalesce(F.col(text), F.lit(""))
    if trigrams:
        found = stage(candidates(build_index(docs, trigrams, text), rules), "secret-candidates")
        found = found.select(F.col("key").alias(key), F.col("kinds").alias(kinds))
        side = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
        docs = docs.join(side, F.xxhash64(value) == F.col(key), "left").drop(key)
    else:
        docs = docs.withColumn(kinds, F.lit(None).cast("array<string>"))
    every = []
    for number, rule in enumerate(rules):
        all_of = _of_kind(spans(value, rule), number)
        if queries[rule.kind] is not True:
            all_of = F.when(F.array_contains(kinds, rule.kind), all_of).otherwise(_no_spans())
        every.append(all_of)
    return docs.withColumn(name, F.array_sort(F.flatten(F.array(*every)))).drop(kinds), name


def listed(found: Column, rules: tuple[Rule, ...] = RULES, kinds: int | None = None) -> Column:
    """``kind:start:end``, comma-joined; only the first ``kinds`` rules if given."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    if kinds is not None:
        found = F.filter(found, lambda s: s["kind"] < kinds)
    text = F.transform(found, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", text)


def redact(text: Column, found: Column, by: str = "[SECRET]") -> Column:
    """``text`` with every span replaced; overlapping spans are replaced together."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        keep = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        mark = F.when(s["start"] >= state["at"], F.lit(by)).otherwise(F.lit(""))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], keep, mark).alias("out")
        )

    def rest(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    return F.when(F.size(found) > 0, F.aggregate(found, start, step, rest)).otherwise(text)
