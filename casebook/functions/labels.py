"""Value labels and code mappings used by the analyses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels of a signed change.
GROWTH_LABEL = "GROWTH (↑)"
REDUCTION_LABEL = "REDUCTION (↓)"
BALANCED_LABEL = "Balanced (=)"

# Segment code mapping (digit -> age band, letter -> demographic).
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}
DEMOGRAPHICS = {"C": "Couples", "F": "Families"}
UNKNOWN = "unknown"

# Weekday names in dayofweek order (1 = Sunday).
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def day_name(c) -> Column:
    """Full weekday name of a date or timestamp, without a time-zone step."""
    c = F.col(c) if isinstance(c, str) else c
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), F.dayofweek(F.to_date(c)))


MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
               "November", "December"]


def month_name(c) -> Column:
    """Full month name of a date or timestamp, without a time-zone step."""
    c = F.col(c) if isinstance(c, str) else c
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.month(F.to_date(c)))


def change_label(diff) -> Column:
    diff = F.col(diff) if isinstance(diff, str) else diff
    return (F.when(diff > 0, GROWTH_LABEL).when(diff < 0, REDUCTION_LABEL)
             .otherwise(BALANCED_LABEL))


def change_label_sql(diff: str) -> str:
    return (f"CASE WHEN {diff} > 0 THEN '{GROWTH_LABEL}' WHEN {diff} < 0 THEN "
            f"'{REDUCTION_LABEL}' ELSE '{BALANCED_LABEL}' END")


def age_band(segment) -> Column:
    seg = F.col(segment) if isinstance(segment, str) else segment
    digit = F.substring(seg, 2, 1)
    out = F.lit(UNKNOWN)
    for k, v in reversed(list(AGE_BANDS.items())):
        out = F.when(digit == k, v).otherwise(out)
    return out


def demographic(segment) -> Column:
    seg = F.col(segment) if isinstance(segment, str) else segment
    out = F.lit(UNKNOWN)
    for k, v in reversed(list(DEMOGRAPHICS.items())):
        out = F.when(seg.startswith(k), v).otherwise(out)
    return out


def age_band_sql(seg: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in AGE_BANDS.items())
    return f"CASE substring({seg}, 2, 1) {whens} ELSE '{UNKNOWN}' END"


def demographic_sql(seg: str) -> str:
    whens = " ".join(f"WHEN {seg} LIKE '{k}%' THEN '{v}'" for k, v in DEMOGRAPHICS.items())
    return f"CASE {whens} ELSE '{UNKNOWN}' END"
