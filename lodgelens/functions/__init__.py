"""Column functions (see :mod:`lodgelens.functions.exprs`)."""

from lodgelens.functions.exprs import (  # noqa: F401
    amenities_count, date_key, date_parts, days_since, indicator, indicator_rate,
    indicator_sum, parse_bathrooms, parse_bool, parse_date, parse_double, parse_int,
    parse_long, parse_percent, parse_price, price_bucket, price_category,
    round_half_up, safe_ratio, text_length, token_count, truncate_text,
)
