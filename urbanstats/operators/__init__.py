from urbanstats.operators.aggregates import (
    count_by,
    count_by_month,
    grand_total,
    row_count,
    share_of_total,
    sum_by_key,
    weighted,
)
from urbanstats.operators.joins import STRATEGIES, join_with_strategy
from urbanstats.operators.ranking import rank_months, top_n_per_group

__all__ = [
    "STRATEGIES",
    "count_by",
    "count_by_month",
    "grand_total",
    "join_with_strategy",
    "rank_months",
    "row_count",
    "share_of_total",
    "sum_by_key",
    "top_n_per_group",
    "weighted",
]
