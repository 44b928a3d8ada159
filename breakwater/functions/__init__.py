from breakwater.functions.expressions import (  # noqa: F401
    any_null,
    break_id,
    contains_text,
    control_band,
    dashboard_band,
    is_iso_date,
    notional,
    percent,
    plain_price,
    severity_of,
    severity_rank,
    to_money,
)
