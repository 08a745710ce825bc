"""Column expressions shared by the staging models and the marts."""

from growthmill.functions.channels import (
    channel_ga4,
    channel_segment,
    channel_utm,
    normalize_channel,
    spend_channel,
)
from growthmill.functions.dates import hours_between, in_days, month_start, week_of_year_sunday, week_start_sunday
from growthmill.functions.numeric import from_micros, lenient_number, safe_divide, safe_divide_or
from growthmill.functions.text import lower_or_null, surrogate_key

__all__ = [
    "channel_ga4",
    "channel_segment",
    "channel_utm",
    "from_micros",
    "hours_between",
    "in_days",
    "lenient_number",
    "lower_or_null",
    "month_start",
    "normalize_channel",
    "safe_divide",
    "safe_divide_or",
    "spend_channel",
    "surrogate_key",
    "week_of_year_sunday",
    "week_start_sunday",
]
