"""DataFrame-in, DataFrame-out operators shared by every layer."""

from .calendar import (
    calendar_attributes, calendar_fill, calendar_of, day_range, days_of, history_window,
)
from .dedup import dedup_latest, latest_state, top1_by
from .gaps import sessions, silences
from .incremental import anchor, coverage, missing_days, missing_domains, pending
from .joins import salted_left_join, temporal_snapshot_join
from .nested import explode_lines, flatten, replicate_and_thin
from .ranking import ntile_distributed, ntile_scores
from .rollup import with_total
from .rules import Rule, apply_rules, reject_breakdown, route
from .series import lagged, moving, moving_days, running_in_month
from .versions import (
    as_of, latest_partition, merge_schema, retention, snapshot_history, version_counts, version_diff,
)

__all__ = [
    "Rule", "anchor", "apply_rules", "as_of", "calendar_attributes", "calendar_fill", "calendar_of",
    "coverage", "day_range", "days_of", "dedup_latest", "explode_lines", "flatten",
    "history_window", "lagged",
    "latest_partition", "latest_state", "merge_schema", "missing_days", "missing_domains",
    "moving", "moving_days", "ntile_distributed", "ntile_scores", "pending", "reject_breakdown",
    "replicate_and_thin", "retention", "route", "running_in_month", "salted_left_join", "sessions",
    "silences", "snapshot_history", "temporal_snapshot_join", "top1_by", "version_counts",
    "version_diff", "with_total",
]
