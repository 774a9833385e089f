"""Column expressions shared by all operators (JVM-side, codegen friendly)."""

from queryscope.functions.exprs import (  # noqa: F401
    click_position_of,
    div_half_up,
    money_avg,
    round2_avg,
    round2_money_avg,
    date_minus_days,
    epoch_micros,
    is_event,
    norm_term,
    pct2,
    pct_text,
    ratio0,
    region_of,
    safe_ratio,
    search_type_of,
)
