"""Column-level helpers (no Python UDFs; all are Catalyst expressions)."""

from casebook.functions.numeric import exact_avg, money, pct  # noqa: F401
