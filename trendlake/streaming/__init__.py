"""trendlake.streaming."""
