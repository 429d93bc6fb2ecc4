from trendlake.functions.scalar import (
    band,
    elapsed_days,
    event_ts,
    exact_half_even,
    join_text,
    min_max,
    node_name,
    pct,
    per_day,
    safe_ratio,
)

__all__ = ["band", "elapsed_days", "event_ts", "exact_half_even", "join_text", "min_max",
           "node_name", "pct", "per_day", "safe_ratio"]
