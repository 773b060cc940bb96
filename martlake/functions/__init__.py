from martlake.functions.scalar import (  # noqa: F401
    COMMERCIAL_EXCLUDED,
    commercial,
    day_floor,
    delivery_days,
    hours_between,
    days_between,
    is_late,
    money,
    money_sum,
    month_start,
    null_safe_bool,
    ntz,
    ratio,
    square_sum,
    strip,
    weighted_sum,
)
