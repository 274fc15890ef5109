from martline.functions.scalars import (  # noqa: F401
    base_name, elapsed_seconds, full_name, incentive, month_start, padded, month_text,
    strict_date, truncate_text, typed_or_null,
)
