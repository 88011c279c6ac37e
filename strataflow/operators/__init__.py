from strataflow.operators.aggregates import distinct_dates, high_watermark, preview, sum_by
from strataflow.operators.asof import join_as_of
from strataflow.operators.dedup import any_per_key, latest_per_key, one_per_change
from strataflow.operators.history import (
    END, START, as_of, closed_versions, current_versions, scd1, scd2,
)
from strataflow.operators.metajoin import build as build_join
from strataflow.operators.quality import (
    RuleBroken, classify, expect_all_or_drop, expect_all_or_fail, split,
)

__all__ = [
    "distinct_dates", "high_watermark", "preview", "sum_by", "join_as_of",
    "any_per_key", "latest_per_key", "one_per_change",
    "END", "START", "as_of", "closed_versions", "current_versions", "scd1", "scd2",
    "build_join", "classify", "expect_all_or_drop", "expect_all_or_fail", "split", "RuleBroken",
]
