"""Display labels as native columns, so that a report is formatted inside the same plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fixed(value: Column, digits: int) -> Column:
    """Rounded half-even to ``digits`` decimals, without thousands separators."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def volume_label(value: Column) -> Column:
    """``1.23T``, ``1.23B``, ``1.23M``, ``1.23K``, else a whole number with separators."""
    label = None
    for floor, suffix in ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K")):
        text = F.concat(_fixed(value / floor, 2), F.lit(suffix))
        label = F.when(value >= floor, text) if label is None else label.when(value >= floor, text)
    return label.otherwise(F.format_number(value, 0))


def currency_label(value: Column) -> Column:
    return F.concat(F.lit("$"), volume_label(value))


def price_label(value: Column) -> Column:
    """Two decimals from 1 upwards (separators from 1000), four decimals below 1."""
    return F.concat(
        F.lit("$"),
        F.when(value >= 1000, F.format_number(value, 2))
        .when(value >= 1, _fixed(value, 2))
        .otherwise(_fixed(value, 4)),
    )


def signed_price_label(change: Column) -> Column:
    """A price change: gains get a leading plus."""
    return F.concat(F.when(change >= 0, F.lit("+")).otherwise(F.lit("")), price_label(change))


def signed_percent_label(percent: Column) -> Column:
    return F.concat(
        F.when(percent >= 0, F.lit("+")).otherwise(F.lit("")), _fixed(percent, 2), F.lit("%")
    )


def age_label(minutes: Column) -> Column:
    """``Just now``, ``N minutes ago``, ``X.Y hours ago`` or ``X.Y days ago``."""
    hours = minutes / 60
    return (
        F.when(minutes < 1, F.lit("Just now"))
        .when(
            minutes < 60,
            F.concat(F.bround(minutes, 0).cast("bigint").cast("string"), F.lit(" minutes ago")),
        )
        .when(hours < 24, F.concat(_fixed(hours, 1), F.lit(" hours ago")))
        .when(minutes.isNotNull(), F.concat(_fixed(hours / 24, 1), F.lit(" days ago")))
    )


def window_label(seconds: Column) -> Column:
    """``Ns``, ``Nm``, ``Nh`` or ``Nd`` in the largest unit that fits, rounded down."""

    def whole(unit: int, suffix: str) -> Column:
        return F.concat(F.floor(seconds / unit).cast("string"), F.lit(suffix))

    return (
        F.when(seconds < 60, whole(1, "s"))
        .when(seconds < 3600, whole(60, "m"))
        .when(seconds < 86400, whole(3600, "h"))
        .otherwise(whole(86400, "d"))
    )
