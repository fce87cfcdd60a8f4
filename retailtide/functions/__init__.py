"""Scalar column functions: times, masks, ages, shares, terms."""

from .labels import AGE_BANDS, GENDERS, METRICS, STAT_TITLES
from .text import matches_all, mask_phone, price, tokens
from .time import (
    age_years,
    arrival_time,
    created_date,
    created_hour,
    event_time,
    log_date,
    log_hour,
    previous_day,
    stamp_arrival,
)
from .maps import last_values, no_repeats
from .measure import age_band, money, one_decimal_percent
from .plan import once

__all__ = [
    "AGE_BANDS",
    "GENDERS",
    "METRICS",
    "STAT_TITLES",
    "age_band",
    "age_years",
    "arrival_time",
    "created_date",
    "created_hour",
    "event_time",
    "last_values",
    "log_date",
    "log_hour",
    "mask_phone",
    "matches_all",
    "money",
    "no_repeats",
    "once",
    "one_decimal_percent",
    "previous_day",
    "price",
    "stamp_arrival",
    "tokens",
]
