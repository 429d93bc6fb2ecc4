"""trendlake.plans."""
