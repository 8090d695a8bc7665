"""Data-quality checks: every count of a check set comes from one pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICES = ("open", "high", "low", "close")
MAX_PRICE = 1e12  # fixed value

_NOT_NULL = "expect_column_values_to_not_be_null"
_BETWEEN = "expect_column_values_to_be_between"

# The declared expectations for silver candles.
SILVER_SUITE = {
    "expectations": [
        {"expectation_type": _NOT_NULL, "kwargs": {"column": "open_time"}},
        {"expectation_type": _NOT_NULL, "kwargs": {"column": "symbol"}},
        {"expectation_type": _BETWEEN, "kwargs": {"column": "open", "min_value": 0, "max_value": 1e12}},
        {"expectation_type": _BETWEEN, "kwargs": {"column": "high", "min_value": 0, "max_value": 1e12}},
        {"expectation_type": _BETWEEN, "kwargs": {"column": "low", "min_value": 0, "max_value": 1e12}},
        {"expectation_type": _BETWEEN, "kwargs": {"column": "close", "min_value": 0, "max_value": 1e12}},
        {"expectation_type": _BETWEEN, "kwargs": {"column": "volume", "min_value": 0, "max_value": 1e20}},
    ]
}


class QualityError(ValueError):
    """Raised when rows break the quality rules; carries the failing counts."""

    def __init__(self, failed: dict[str, int]):
        self.failed = failed
        super().__init__("quality checks failed: " + ", ".join(f"{k}={v}" for k, v in failed.items()))


def quality_counts(df: DataFrame) -> DataFrame:
    """One row with the number of rows that break each rule. Null prices are allowed."""
    price = {
        f"invalid_{c}": F.count_if((F.col(c) < 0) | (F.col(c) > MAX_PRICE)) for c in PRICES
    }
    counts = {
        "null_open_time": F.count_if(F.col("open_time").isNull()),
        "null_symbol": F.count_if(F.col("symbol").isNull() | (F.col("symbol") == "")),
        **price,
        "invalid_volume": F.count_if((F.col("volume") < 0) | F.isnan("volume")),
    }
    return df.agg(*[count.alias(name) for name, count in counts.items()])


def validate(df: DataFrame) -> bool:
    """True, or :class:`QualityError`. Missing keys are reported before bad values."""
    counts = quality_counts(df).first().asDict()
    for prefix in ("null_", "invalid_"):
        failing = {k: v for k, v in counts.items() if k.startswith(prefix)}
        if any(failing.values()):
            raise QualityError(failing)
    return True


_ARGUMENTS = {_NOT_NULL: {"column"}, _BETWEEN: {"column", "min_value", "max_value"}}


def _violates(kind: str, kwargs: dict) -> Column:
    if kind not in _ARGUMENTS:
        raise ValueError(f"unknown expectation {kind!r}")
    unknown = set(kwargs) - _ARGUMENTS[kind]
    if unknown:
        raise ValueError(f"{kind} has no argument {', '.join(sorted(unknown))}")
    c = F.col(kwargs["column"])
    if kind == _NOT_NULL:
        return c.isNull()
    low, high = kwargs.get("min_value"), kwargs.get("max_value")
    outside = F.lit(False)
    if low is not None:
        outside = outside | (c < low)
    if high is not None:
        outside = outside | (c > high)
    return outside


def run_suite(df: DataFrame, suite: dict = SILVER_SUITE) -> DataFrame:
    """One row per expectation of ``suite``: ``expectation, column, failed, success``."""
    checks = [(e["expectation_type"], e["kwargs"]) for e in suite["expectations"]]
    counted = df.agg(
        *[F.count_if(_violates(kind, kw)).alias(f"c{i}") for i, (kind, kw) in enumerate(checks)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(kind).alias("expectation"),
                F.lit(kw["column"]).alias("column"),
                F.col(f"c{i}").alias("failed"),
                (F.col(f"c{i}") == 0).alias("success"),
            )
            for i, (kind, kw) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))
