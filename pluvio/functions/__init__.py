"""Column-expression helpers. Everything here returns a ``Column``; nothing runs Python per row."""
from pluvio.functions.nulls import (  # noqa: F401
    null_tokens, sum_keep_null, sum_or_zero, strict_sum, r_if_else, row_total,
    row_null_count, finite_or_null, round_floats,
)
from pluvio.functions.dates import (  # noqa: F401
    parse_timestamp, parse_date, any_date, floor_minutes, anchored_bin,
    ampm_timestamp, day_month_ambiguous, days_in_month, month_label,
)
