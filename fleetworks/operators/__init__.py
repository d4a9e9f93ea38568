from fleetworks.operators.expand import (
    active_count_by_day,
    calendar_days,
    each_of,
    expand_days,
    expand_months,
    scalar_array,
)
from fleetworks.operators.grouping import (
    best_per_group,
    conditional_pivot,
    frequency,
    monthly_sum,
    share_of_group,
)
from fleetworks.operators.numbering import number_rows, rank_and_accumulate, running_totals
from fleetworks.operators.sessions import cluster_by_gap, gap_since_previous
from fleetworks.operators.timeline import carry_forward, exists_within, flag_upcoming, next_at_or_after, rolling_days

__all__ = [
    "active_count_by_day", "calendar_days", "each_of", "expand_days", "expand_months", "scalar_array",
    "best_per_group", "conditional_pivot", "frequency", "monthly_sum", "share_of_group",
    "number_rows", "rank_and_accumulate", "running_totals", "cluster_by_gap", "gap_since_previous",
    "carry_forward", "exists_within", "flag_upcoming", "next_at_or_after", "rolling_days",
]
