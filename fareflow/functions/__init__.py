"""Column expressions; all built-in functions, so they stay inside codegen."""

from fareflow.functions.columns import (
    duration_minutes,
    in_hash_split,
    in_share,
    in_split,
    moment,
    percent_of,
    round_stable,
)

__all__ = [
    "duration_minutes",
    "in_hash_split",
    "in_share",
    "in_split",
    "moment",
    "percent_of",
    "round_stable",
]
