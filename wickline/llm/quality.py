"""Document quality rules as a short-circuit cascade, ordered by rejection per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import SPACE, fresh, let, stage, words

#: Fixed values of the measures.
SYMBOLS, SPACES, WINDOW = "#*$%&|<>", " \t\n\x0b\x0c\r", 5


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE[1:-1]}]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def n_repeat_words(found: Column) -> Column:
    """Words covered by 5-word windows that occur twice or more in the array ``found``.

    Windows are compared by their words' hashes, joined to a 64-bit hash of the window. Sorting puts
    equal ones side by side; the covered words follow from the sorted starts of repeated windows.
    """
    last = F.size(found) - WINDOW

    def windows(hashes: Column) -> Column:
        one = lambda i: F.struct(F.xxhash64(*[hashes[i + j] for j in range(WINDOW)]).alias("h"), i.alias("i"))
        return F.array_sort(F.transform(F.sequence(F.lit(0), last), one))

    def repeated(ordered: Column) -> Column:
        def equal(x: Column, k: Column) -> Column:
            before = F.get(ordered, k - 1)["h"] == x["h"]
            after = F.get(ordered, k + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.array_sort(F.transform(F.filter(ordered, equal), lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        gap = lambda x, k: F.least(F.coalesce(F.get(starts, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))
        return F.aggregate(F.transform(starts, gap), F.lit(0), lambda total, x: total + x)

    hashes = F.transform(found, lambda w: F.xxhash64(w))
    counted = let(let(let(hashes, windows), repeated), covered)
    return F.when(last < 1, F.lit(0)).otherwise(counted).cast("bigint")


@dataclass(frozen=True)
class Rule:
    """Rejects a document where ``fails``, a condition over measures by name, is true."""

    name: str
    fails: Callable[[dict[str, Column]], Column]


BASE = (
    Rule("too_short", lambda m: m["n_words"] < 10),
    Rule("repeats_itself", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
)
#: The method's own rules: mostly symbols, mostly repeated lines, words too long or short on average.
RULES = (
    *BASE,
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["word_chars"]),
    Rule("same_lines", lambda m: 10 * m["n_dup_lines"] > m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 30 * m["n_words"]),
    Rule("short_words", lambda m: 2 * m["word_chars"] < 3 * m["n_words"]),
)


def measures(text: Column) -> dict[str, Column]:
    """The measures by name; null counts as the empty text. Each is computed only where it is used."""
    value = F.coalesce(text, F.lit(""))
    return {
        "n_words": F.size(words(value)).cast("bigint"),
        "word_chars": word_chars(value),
        "n_symbols": n_symbols(value),
        "n_dup_lines": n_dup_lines(value),
        "n_repeat_words": let(words(value), n_repeat_words),
    }


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    rejected: float
    seconds: float


def estimate(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", sample_rows: int = 1000) -> list[Estimate]:
    """Share of rejected rows and cost of each rule, from a sample of ``sample_rows`` rows at most.

    The sample is written once; each rule is then run alone over it, after a first run that only warms
    up. The estimate steers the order of evaluation and never changes a verdict.
    """
    rows = docs.select(text).limit(8 * sample_rows).sample(0.125, seed=7).limit(sample_rows)
    sample = stage(rows.coalesce(1), "quality-sample")
    found = []
    for rule in (rules[0], *rules):
        started = time.perf_counter()
        bad, total = sample.agg(F.count_if(rule.fails(measures(F.col(text)))), F.count("*")).first()
        found.append(Estimate(rule, bad / max(total, 1), time.perf_counter() - started))
    return found[1:]


def cascade_order(estimates: list[Estimate]) -> tuple[Rule, ...]:
    """Rules by rejected share per second, the best first."""
    return tuple(e.rule for e in sorted(estimates, key=lambda e: -e.rejected / max(e.seconds, 1e-6)))


def first_failed(rules: tuple[Rule, ...], known: dict[str, Column]) -> Column:
    """Name of the first rule in this order that rejects, null if none does; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.fails(known), F.lit(rule.name)).otherwise(verdict)
    return verdict


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 1000) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, with the cheapest rejections tried first.

    Null and empty texts have no words and are rejected as too short; repeated rows are judged each.
    """
    order = cascade_order(estimate(docs, rules, text, sample_rows))
    return docs.filter(first_failed(order, measures(F.col(text))).isNull())


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 1000) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: a struct of all measures, ``failed_base`` and ``failed``.

    ``failed`` is the first rule of the cascade that rejects. The column is called ``quality``, with
    underscores before it if ``docs`` has such a column.
    """
    order = cascade_order(estimate(docs, rules, text, sample_rows))
    name = fresh(docs, "quality")
    docs = docs.withColumn(name, F.struct(*[c.alias(n) for n, c in measures(F.col(text)).items()]))
    known = {n: F.col(f"{name}.{n}") for n in measures(F.lit(""))}
    base = F.array(*[r.fails(known) for r in rules if r in BASE])
    failed_base = F.exists(base, lambda x: x)
    return docs.withColumn(
        name, F.struct(f"{name}.*", failed_base.alias("failed_base"), first_failed(order, known).alias("failed"))
    ), name
