"""Column expressions."""

from riskstream.functions.columns import (
    flag_or_false,
    id_order,
    iso_text,
    month_label,
    of_accepted_year,
    over_threshold,
    parsed_timestamp,
    readable_timestamp,
    period_start,
    sample_order,
    usable_amount,
)

__all__ = [
    "flag_or_false",
    "id_order",
    "iso_text",
    "month_label",
    "of_accepted_year",
    "over_threshold",
    "parsed_timestamp",
    "readable_timestamp",
    "period_start",
    "sample_order",
    "usable_amount",
]
