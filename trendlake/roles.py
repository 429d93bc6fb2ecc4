"""Column roles: which input column plays which part in the analytics.

The operators never hard-code column names; they read them from a ``Roles``
value, so the same code runs on the item records of the original pipeline
(``REFERENCE_ROLES``) and on any other table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Roles:
    key: str | None = "id"
    category: str | None = "language"
    measure: str | None = "stars"
    measure2: str | None = "forks"
    measure3: str | None = "open_issues"
    event_time: str | None = "created_at"
    update_time: str | None = "updated_at"
    tags: str | None = "topics"
    name: str | None = "name"
    description: str | None = "description"

    def with_(self, **changes) -> "Roles":
        return replace(self, **changes)


# Item record of the original pipeline.
REFERENCE_ROLES = Roles()

# Names of derived columns added by ``base_table``.
TS_COL = "created_ts"
YEAR_COL = "year"
MONTH_COL = "month"

# Names of result columns and report labels that outputs share
# with the original reports.
COUNT_COL = "repo_count"
TOTAL_COL = "total_stars"
MONTH_METRIC = "month_wise_trend"
TAG_METRIC = "topic_trend"
RAW_METRIC_PREFIX = "stars_ge_"

# Further result columns shared with the original reports, by the
# operator that names them.
RESULT_COLUMNS = {
    "yoy_growth": ("prev_count", "growth_rate_pct"),
    "mean_by": ("avg_stars_per_repo",),
    "productivity": ("total_forks", "total_open_issues", "productivity_score", "activity_proxy_score"),
    "features": ("repo_age_days", "stars_per_day", "fork_star_ratio", "repo_age_norm"),
    "quality_report": ("row_count", "duplicate_repo_ids", "null_language_pct", "schema_missing_columns",
                       "schema_extra_columns"),
    "forecast": ("predicted_repo_count", "lower_ci", "upper_ci"),
    "model_selection": ("linear_mae", "linear_rmse", "arima_mae", "arima_rmse", "selected_model"),
    "graph_metrics": ("node", "degree_centrality", "betweenness_centrality"),
    "clusters": ("cluster_id",),
    "run_metrics": ("timestamp_utc",),
}
