from wickline.functions.labels import (
    age_label,
    currency_label,
    price_label,
    signed_percent_label,
    signed_price_label,
    volume_label,
    window_label,
)
from wickline.functions.times import (
    DAY_US,
    HOUR_US,
    MINUTE_US,
    SECOND_US,
    as_date,
    as_micros,
    bucket_start,
    date_range,
    readable_time,
    utc_date,
    week_label,
)

__all__ = [
    "DAY_US",
    "HOUR_US",
    "MINUTE_US",
    "SECOND_US",
    "age_label",
    "as_date",
    "as_micros",
    "bucket_start",
    "currency_label",
    "date_range",
    "price_label",
    "readable_time",
    "signed_percent_label",
    "signed_price_label",
    "utc_date",
    "volume_label",
    "week_label",
    "window_label",
]
