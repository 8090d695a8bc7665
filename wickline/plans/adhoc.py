"""Read-only SQL over the registered views."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ROW_CAP = 100  # fixed value: rows that a console shows; never applied unless asked for

# What a query says outside of its words: string literals and comments.
_QUOTED = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|--[^\n]*|/\*.*?\*/""", re.DOTALL)
# Reflection runs JVM code; identifier() makes names out of literals.
_ESCAPES = re.compile(r"\b(?:reflect|try_reflect|java_method)\b|\bidentifier\s*\(", re.IGNORECASE)
# Files as tables: format.name after FROM, JOIN, TABLE or a comma, or any part in backticks that is a path or a class.
_FILES = re.compile(
    r"(?:\bfrom|\bjoin|\btable|,)\s*`?(?:parquet|orc|csv|json|text|xml|avro|binaryfile|libsvm|image)`?\s*\."
    r"|\.\s*`[^`]*[/\\:][^`]*`|`[^`]*\.[^`]*`\s*\.",
    re.IGNORECASE,
)


def ask_sql(
    spark: SparkSession,
    sql: str,
    args: dict | None = None,
    cap: int | None = None,
    require: tuple[str, ...] = (),
) -> DataFrame:
    """The result of one query, all rows, or at most ``cap`` if that is given.

    The text is placed inside a subquery, where Spark's grammar admits nothing but a query: statements
    that define, change or set anything fail to parse and never run. ``args`` binds ``:name`` markers.
    With ``require``, each table scan must be bounded on all of those partition columns: by equality,
    by a list, or from both sides. This is read off the optimized plan, where Spark has pushed each predicate
    to the tables that it bounds, through aliases, unions, joins and subqueries.

    This is a read-only gate, not a sandbox: it also closes file paths as tables and the reflection
    functions, but every view of the session stays readable.
    """
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise ValueError("the query is empty")
    words = _QUOTED.sub("''", text)
    if _ESCAPES.search(words):
        raise ValueError("reflection functions and identifier() are not allowed in a query")
    if _FILES.search(words):
        raise ValueError("files (parquet.`...`) are not allowed as tables")
    query = f"SELECT * FROM (\n{text}\n)"
    result = spark.sql(query, args=args)
    if require:
        _require_bounds(result._jdf.queryExecution().optimizedPlan(), require)
    return result if cap is None else result.limit(cap)


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _each(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _conjuncts(condition) -> list:
    if _kind(condition) == "And":
        return _conjuncts(condition.left()) + _conjuncts(condition.right())
    return [condition]


def _is_column(expression, column) -> bool:
    return _kind(expression) == "AttributeReference" and expression.exprId().equals(column.exprId())


def _is_value(expression) -> bool:
    return _kind(expression) == "Literal" and expression.value() is not None


_MIRRORED = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}


def _sides(condition, column) -> set[str]:
    """What a predicate says of a column: ``=`` for a value or a list of values, ``<`` and ``>`` for ends."""
    kind = _kind(condition)
    if kind == "And":
        return _sides(condition.left(), column) | _sides(condition.right(), column)
    if kind == "Or":
        left, right = _sides(condition.left(), column), _sides(condition.right(), column)
        return left & right | ({"="} if _closed(left) and _closed(right) else set())
    if kind == "In" and _is_column(condition.value(), column):
        return {"="} if all(map(_is_value, _each(condition.list()))) else set()
    if kind == "InSet" and _is_column(condition.child(), column):
        return {"="}
    if kind in ("EqualTo", "EqualNullSafe", "LessThan", "LessThanOrEqual", "GreaterThan", "GreaterThanOrEqual"):
        sign, left, right = condition.symbol(), condition.left(), condition.right()
        if _is_column(right, column):
            left, right, sign = right, left, _MIRRORED.get(sign, sign)
        if _is_column(left, column) and _is_value(right):
            return {sign[0] if sign in _MIRRORED else "="}
    return set()


def _closed(sides: set[str]) -> bool:
    return "=" in sides or {"<", ">"} <= sides


def _require_bounds(plan, columns: tuple[str, ...], above: tuple = ()) -> None:
    """Refuse a plan with a scan of rows that is not bounded on every one of ``columns``.

    ``above`` are the predicates between the scan and the next join, union or aggregation above it.
    """
    kind = _kind(plan)
    for inner in _each(plan.subqueries()):
        _require_bounds(inner, columns)
    if kind == "Filter":
        _require_bounds(plan.child(), columns, (*above, *_conjuncts(plan.condition())))
    elif kind in ("Project", "SubqueryAlias"):
        _require_bounds(plan.child(), columns, above)
    elif kind == "CommandResult":
        raise ValueError("commands are not allowed in a query")
    elif plan.children().size():
        for child in _each(plan.children()):
            _require_bounds(child, columns)
    elif kind not in ("OneRowRelation", "LocalRelation", "Range"):
        held = {a.name().lower(): a for a in _each(plan.output())}
        for c in columns:
            column = held.get(c.lower())
            if column is None or not _closed(set().union(*(_sides(p, column) for p in above))):
                raise ValueError(f"the query must bound {', '.join(columns)}")
