from bazaar.functions.columns import (  # noqa: F401
    ts_or_null, ts_strict, as_timestamp, elapsed_days, month_label, period_first,
    period_last, order_status_code, principal_category, delivered_on_time,
    location_key, paid_search_adjusted, round_half_even, review_score_class,
    sentiment_class,
)
from bazaar.functions.text import (  # noqa: F401
    tokens, clean_text,
)
