"""Column-level helpers (built-in Spark expressions only, except NFKD folding)."""

from basketlens.functions.dates import (  # noqa: F401
    as_of_date, calendar_days, elapsed_days, month_diff, month_start, to_day,
)
from basketlens.functions.numeric import half_up_ratio, pct, round_half_up_units  # noqa: F401
