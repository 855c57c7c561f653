from bazaarlens.operators.dedup import dedup_keep_first
from bazaarlens.operators.distinct import count_distinct_each
from bazaarlens.operators.joins import spread_join
from bazaarlens.operators.quality import (
    check_violations,
    fk_orphans,
    length_violations,
    null_counts,
    pk_violations,
)
from bazaarlens.operators.ranking import ntile_global, ntile_of_top, rank_global, top_k
from bazaarlens.operators.shares import bucketize, period_change, running_share, share_of_total

__all__ = [
    "bucketize",
    "check_violations",
    "count_distinct_each",
    "dedup_keep_first",
    "fk_orphans",
    "length_violations",
    "ntile_global",
    "ntile_of_top",
    "null_counts",
    "period_change",
    "pk_violations",
    "rank_global",
    "running_share",
    "share_of_total",
    "spread_join",
    "top_k",
]
