from trackside.operators import hot
from trackside.operators.dedup import latest_by_key
from trackside.operators.lookup import next_row_lookup, not_in, only_new
from trackside.operators.ordered import (
    delta_to_median,
    group_quantile,
    islands,
    rank_within,
    running_total,
    sequence_within,
)

__all__ = [
    "delta_to_median",
    "group_quantile",
    "hot",
    "islands",
    "latest_by_key",
    "next_row_lookup",
    "not_in",
    "only_new",
    "rank_within",
    "running_total",
    "sequence_within",
]
